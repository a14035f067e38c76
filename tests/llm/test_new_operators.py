"""Fill-in-middle, Merkle manifest and SentencePiece agenda: each on the awkward
tables and on cases of their own, against brute force or the library."""

import hashlib
import random
import re
import zlib

import public_tokenizers
import pytest
import sentencepiece

from ledgerline.llm import merkle_rollup, middle_fill, piece_agenda
from ledgerline.llm.queries import queries

Q = queries()
MODEL = public_tokenizers.path("piece_bpe_32k.model")


def sha(text):
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


def ordered(rows):
    return sorted(map(tuple, rows), key=repr)


# -- fill-in-middle ---------------------------------------------------------

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def expected_middle(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    digest = sha(f"42:{'' if doc_id is None else doc_id}")
    h = [int(digest[i:i + 8], 16) for i in (0, 8, 16, 24)]
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return doc_id, n, "plain", None, None, sha(text), sha(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    form = "spm" if h[3] % 100 < 80 else "psm"
    out = f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"
    return doc_id, n, form, len(p), len(m), sha(out), sha(text)


def test_op11_awkward(spark, llm_dir, doc_rows):
    got = Q["op11_fill_in_middle"](spark, llm_dir).collect()
    assert ordered(got) == ordered(expected_middle(*r) for r in doc_rows)


def test_middle_random_texts():
    rng = random.Random(5)
    alphabet = ["a", "Z", " ", "\n", "\t", "\x0b", "é", "　", "漢", "😀", "\x1f", "<", "P>", "S>", "M>", "<P", "\x00", "\u0085"]
    forms = set()
    for doc_id in range(3000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(40)))
        n, form, prefix, middle, out = middle_fill.transform(text.encode(), doc_id)
        assert (doc_id, n, form, prefix, middle, hashlib.sha256(out).hexdigest()) == expected_middle(doc_id, text)[:6]
        assert middle_fill.restore(out, form).decode() == text
        forms.add(form)
    assert forms == {"plain", "psm", "spm"}


def test_exception_index():
    text = "aé漢b😀 c" * 50
    data = text.encode()
    index = middle_fill.ExceptionIndex(middle_fill.np.frombuffer(data, "u1"))
    assert len(index.bytes) == 150  # ASCII has no entry
    for point in range(len(text) + 1):
        byte = len(text[:point].encode())
        assert index.to_byte(point) == byte and index.to_point(byte) == point
    plain = middle_fill.ExceptionIndex(middle_fill.np.frombuffer(b"only ascii", "u1"))
    assert len(plain.bytes) == 0 and plain.to_byte(7) == 7 == plain.to_point(7)


def test_middle_output_column(spark):
    docs = spark.createDataFrame([(7, "one two three"), (None, None)], "doc_id long, text string")
    rows = {r.doc_id: r for r in middle_fill.fill_in_middle(docs, ["doc_id"], transformed=100).collect()}
    assert rows[None].form == "plain" and rows[None].output == ""
    assert sha(rows[7].output) == rows[7].output_sha256
    assert middle_fill.restore(rows[7].output.encode(), rows[7].form) == b"one two three"


# -- Merkle manifest --------------------------------------------------------

def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def expected_manifest(rows, arity=2):
    """rows: (doc_id, source, lang, n_chars, text)."""
    def leaf_of(doc_id, source, lang, n_chars, text):
        return sha("".join(map(field, (doc_id, source, lang, n_chars, text))))

    def build(nodes):
        """Root, and per node its (before, after) siblings upwards."""
        paths, at = [[] for _ in nodes], list(range(len(nodes)))
        while len(nodes) > 1:
            for k, i in enumerate(at):
                run = nodes[i // arity * arity:i // arity * arity + arity]
                paths[k].append(("".join(run[:i % arity]), "".join(run[i % arity + 1:])))
                at[k] = i // arity
            nodes = [sha("".join(nodes[j:j + arity])) for j in range(0, len(nodes), arity)]
        return (nodes[0] if nodes else None), paths

    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        mine = sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(*r)))
        trees[lang] = (mine, *build([leaf_of(*r) for r in mine]))
    root, upper = build([trees[x][1] for x in langs])
    out = []
    for lang, above in zip(langs, upper, strict=True):
        mine, subroot, paths = trees[lang]
        for r, path in zip(mine, paths, strict=True):
            path = path + above
            own = leaf_of(*r)
            if zlib.crc32(b"" if r[0] is None else str(r[0]).encode()) % 7 == 0 and r[3] is not None:
                own = leaf_of(*r[:3], r[3] + 1, r[4])
            for before, after in path:
                own = sha(before + own + after)
            out.append((r[0], leaf_of(*r), subroot, root, sha("".join(b + a for b, a in path)), own, own == root))
    return out


COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def test_op12_awkward(spark, llm_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{llm_dir}/documents.parquet").select(*COLUMNS).collect()]
    got = Q["op12_merkle_manifest"](spark, llm_dir).collect()
    assert ordered(got) == ordered(expected_manifest(rows))
    assert {r.verified for r in got} == {True, False}


@pytest.mark.parametrize(("arity", "digits", "n"), [(2, 2, 90), (3, 1, 40), (2, 9, 1)])
def test_manifest_rounds(spark, arity, digits, n):
    """Several rounds of blocks, other arities, hot, NULL and empty languages."""
    rng = random.Random(n)
    rows = [(i if i % 11 else None, rng.choice([None, "s"]), rng.choice(["en"] * 6 + [None, "", "Zz", "é"]), rng.choice([None, i, -i]),
             rng.choice([None, "", "ü" * i])) for i in range(n)]
    rows += rows[:n // 4]  # repeated rows are leaves of their own
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    docs = docs.selectExpr("*", "'x' as tree", "1 as rank", "2 as size", "'y' as leaf").repartition(4)
    got = merkle_rollup.manifest(docs, arity, digits).collect()
    assert ordered(got) == ordered(expected_manifest(rows, arity))


def test_manifest_groupings_share_one_exchange(spark):
    """A round is one exchange on (tree, block), whatever its digits."""
    nodes = spark.range(1000).selectExpr("concat('=', id % 2) as tree", "500L + id % 2 * 0 as size", "id as rank", "sha2(string(id), 256) as hash")
    plan = merkle_rollup.roll(nodes, [], 2, 9)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1


# -- SentencePiece ----------------------------------------------------------

def test_op13_awkward(spark, llm_dir, doc_rows):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    expected = []
    for doc_id, text in doc_rows:
        ids = library.encode(text or "")
        expected.append((doc_id, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids)), True))
    assert ordered(Q["op13_piece_agenda"](spark, llm_dir).collect()) == ordered(expected)


def test_agenda_random_texts():
    enc = piece_agenda.encoder(MODEL)
    rng = random.Random(13)
    alphabet = [" ", "  ", "▁", "a", "the", "ing", "12", "\n", "\t", "é", "日本", "\U0001f600", "<s>", "<unk>", "<0x0A>", "\x00", "́", "....",
                "====", "﻿", "　", "가나", "\U00012345"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(25))) for _ in range(6000)]
    texts += ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(32, 0xD7FF), rng.randrange(0xE000, 0x10FFFF)])) for _ in range(20))
              for _ in range(2000)]
    texts += ["ab" * 20_000, " " * 20_001, "=" * 20_001, "日" * 5_000]
    assert [enc.encode(t) for t in texts] == enc.library.encode(texts)


def test_agenda_as_list_and_as_heap():
    enc, rng = piece_agenda.encoder(MODEL), random.Random(3)
    for _ in range(3000):
        part = "".join(rng.choice(["▁", "t", "h", "e", "i", "n", "g", "é", ".", "\U00012345", "日"]) for _ in range(rng.randrange(1, 48)))
        assert enc.short(part) == enc.long(part)


def test_agenda_as_rows_of_a_matrix(monkeypatch):
    enc, rng = piece_agenda.AgendaEncoder(MODEL), random.Random(5)
    words = ["".join(rng.choice(["▁", "▁▁▁", "t", "h", "e", "in", "g", "é", ".", "\U00012345", "日", "0"]) for _ in range(rng.randrange(1, 16)))
             for _ in range(3000)]
    for found, word in zip(enc.matrix(words), words, strict=True):
        assert found == enc.short(word)
    monkeypatch.setattr(piece_agenda, "MATRIX_CELLS", 64)
    monkeypatch.setattr(piece_agenda, "STEP_CHARS", 100)
    texts = ["", " ".join(words[:700]), "", *(w.replace("▁", " ") for w in words), "x" * 500 + " y", " ", ""]
    fresh = piece_agenda.AgendaEncoder(MODEL)
    got = list(fresh.encode_all(texts))
    assert [t for t, _ in got] == texts
    assert [[int(i) for i in d.split(",") if i] for _, d in got] == fresh.library.encode(texts)
    assert list(fresh.encode_all([])) == []


def test_agenda_tables_are_bounded(monkeypatch):
    monkeypatch.setattr(piece_agenda, "REMEMBERED", 8)
    enc = piece_agenda.AgendaEncoder(MODEL)
    text = " ".join(f"word{i} über{i}" for i in range(300))
    assert enc.encode(text) == enc.library.encode(text)
    assert len(enc._word) <= 8 and len(enc._word.older) <= 8
    texts = [f"word{i} über{i} {text}" for i in range(3)]
    assert [[int(i) for i in d.split(",")] for _, d in enc.encode_all(texts)] == enc.library.encode(texts)
    assert len(enc._word) <= 8 and len(enc._word.older) <= 8


def test_agenda_ids_column(spark):
    docs = spark.createDataFrame([(1, "Hello  world"), (2, None)], "doc_id long, text string")
    rows = {r.doc_id: r for r in piece_agenda.encode_documents(docs, MODEL, ["doc_id"]).collect()}
    assert rows[1].ids == piece_agenda.encoder(MODEL).library.encode("Hello  world") and rows[2].ids == []
