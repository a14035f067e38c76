"""The operators' own interfaces: codec and file round trips, transducer,
streaming decode, index retrieval, ring links, redaction, record files."""

import gzip
import glob
import math
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.llm import (anchor_pii, blocks, bpe_fst, decontaminate, histogram_shards, interpolated_lm, quality_llr,
                            simhash_ring, substring_graph, token_files, warc_derive)
from ledgerline.llm.common import pair_hash, prepare, work_path
from ledgerline.llm.queries import WORD_BPE

RANKS = bpe_fst.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
FST = bpe_fst.MergeTransducer(RANKS)


@given(st.lists(st.integers(0, 2**32 - 1), max_size=60))
@settings(max_examples=200, deadline=None)
def test_rank_codec_round_trip(ranks):
    values = np.asarray(ranks, "<u4")
    control, data = token_files.encode_ranks(values)
    assert len(control) == -(-len(ranks) // 4)
    assert token_files.decode_ranks(control, data, len(ranks)).tolist() == ranks


@given(st.binary(min_size=1, max_size=40) | st.text("aeinrst hT.,", min_size=1, max_size=60).map(str.encode))
@settings(max_examples=300, deadline=None)
def test_transducer_is_the_merge_loop(piece):
    expected = [RANKS[piece]] if piece in RANKS else bpe_fst.merge_by_rank(piece, RANKS)
    assert list(FST.encode_piece(piece)) == expected


def test_transducer_state_limit_changes_nothing():
    small = bpe_fst.MergeTransducer(RANKS, max_states=3, max_pieces=2)
    for w in (b"internationalisation", b"thereabouts", b"\xff\xfe\x00zz", b"thereabouts"):
        assert small.encode_piece(w) == FST.encode_piece(w)


@given(st.binary(max_size=60), st.integers(1, 5))
@settings(max_examples=300, deadline=None)
def test_stream_decode_in_any_chunks(data, step):
    ids = [RANKS[data[i:i + 1]] for i in range(len(data))]
    dec = bpe_fst.StreamDecoder(FST.token)
    out = "".join(dec.feed(ids[i:i + step]) for i in range(0, len(ids), step)) + dec.close()
    assert out == data.decode("utf-8", "replace")


def test_token_files_general_interface(spark, tmp_path):
    docs = spark.createDataFrame([(3, "c d"), (1, "a b"), (2, None)], "doc_id long, text string")
    folder = str(tmp_path / "files")
    token_files.write(docs, WORD_BPE, folder, end_id=49407, frame_ids=1)
    back = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in token_files.read(spark, folder).collect()}
    tok = token_files.tokenizer(WORD_BPE).tokenizer
    assert back == {1: [*tok.encode("a b").ids, 49407], 2: [49407], 3: [*tok.encode("c d").ids, 49407]}
    ranks = [r.id for r in spark.read.parquet(f"{folder}/ranks").orderBy("rank").collect()]
    counts = Counter(i for ids in back.values() for i in ids)
    assert [counts[i] for i in ranks] == sorted(counts.values(), reverse=True)


def test_spellings_of_a_latin_word_meet_the_model_once():
    """Case and a mark at the end make no new word; ids are the library's."""
    tok = token_files.WordTokenizer(WORD_BPE)
    asked = []
    tok.latin_words.make = lambda low: asked.append(low) or tok._latin_word(low)
    text = " ".join(["Quuxling", "quuxling", "QUUXLING,", "quuxling.", "Quuxling."] * 3)
    assert tok.encode(text).tolist() == tok.tokenizer.encode(text, add_special_tokens=False).ids
    assert sorted(asked) == ["quuxling", "quuxling,", "quuxling."]
    for odd in ("It's I'LL ''s ...'s _a_b ²x½ ª É.É! Ǆ,", "a\x0bb\x85c\xa0d\x1ce", "İ ı. Σς", "<|endoftext|> B <|ENDOFTEXT|>", "e\u0301 E\u0301."):
        fresh = token_files.WordTokenizer(WORD_BPE, 2)
        assert fresh.encode(odd).tolist() == fresh.tokenizer.encode(odd, add_special_tokens=False).ids


def test_quality_rules_look_a_text_up_once():
    """One table answers for n-grams, repeats and toxic words, at any limit."""
    values = np.random.default_rng(4).normal(size=1 << 10)
    toxic = quality_llr.ToxicRatio(values, 0.3, 1.0)
    texts = [b"One one, ONE two-three four!five", b"...", b"", b"a\x1cb \xc3\x89t\xc3\xa9 c. c. C.", b"x", b"x y"] * 2
    for limit in (1, 100):
        table, hasher, plain = quality_llr.WordTable(toxic, limit), quality_llr.WordHasher(quality_llr.SEED), quality_llr.WordValues(values)
        for text in texts:
            ids = table.ids(text.split())
            assert quality_llr._rules_of_ids(ids) == quality_llr._base_rules(hasher, text.split())
            assert table.ngrams(ids, 512).tolist() == quality_llr._ngrams(hasher, text.lower().split(), 512).tolist()
            bare = quality_llr._bare_words(text)
            assert table.toxicity(toxic, ids) == (toxic.score(plain, bare) if bare else None)


def test_blocks_answer_like_one_block(spark, llm_dir, monkeypatch):
    docs = spark.read.parquet(f"{llm_dir}/documents.parquet")
    whole = sorted(map(repr, substring_graph.remove_repeats(docs).collect()))
    scores = {repr(r[:5]): (round(r[5], 6), round(r[6], 6)) for r in interpolated_lm.score(docs).collect()}
    pack = blocks.pack
    monkeypatch.setattr(blocks, "pack", lambda *a, **k: pack(*a, **k, block_bytes=3000))
    assert sorted(map(repr, substring_graph.remove_repeats(docs).collect())) == whole
    assert {repr(r[:5]): (round(r[5], 6), round(r[6], 6)) for r in interpolated_lm.score(docs).collect()} == scores


def test_paths_compact_without_branches_and_cycles(spark):
    links = spark.createDataFrame([(1, 2), (2, 3), (3, 4), (3, 5), (7, 8), (8, 9), (9, 7), (4, 6), (5, 5)], "a long, b long")
    got = {r.edge: (r.path, r.place) for r in substring_graph.compact(links).collect()}
    assert got == {1: (1, 0), 2: (1, 1), 3: (1, 2), 4: (4, 0), 6: (4, 1)}


def test_sorted_keys_round_trip():
    rng = np.random.default_rng(1)
    for n in (1, 2, 1000):
        keys = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        assert (blocks.expand_sorted(blocks.squeeze_sorted(keys)) == keys).all()


def test_language_model_prefers_the_corpus(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(["a b", "c d", "e f"]) for _ in range(40))) for i in range(120)]
    got = interpolated_lm.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    held = [r for r in got if r.held_out]
    assert held and sum(r.score for r in held) > sum(r.base_score for r in held)


@pytest.mark.parametrize("n,shards", [(400, 16), (3, 16), (200, 1)])
def test_shards_are_even_and_gapless(spark, n, shards):
    rng = random.Random(n)
    rows = [(i // 3, "x" * rng.randrange(50), "clash") for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, slot string")
    got = histogram_shards.shard(docs, shards=shards, piece_bytes=400).collect()
    assert len(got) == n
    slots: dict[int, list[int]] = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    total = sum(len(t) + 1 for _, t, _ in rows)
    assert max(sum(r["size"] for r in got if r.shard == s) for s in slots) <= total / shards + 51


def test_shard_of_one_repeated_row(spark):
    docs = spark.createDataFrame([(7, "same text")] * 320, "doc_id long, text string")
    got = Counter(r.shard for r in histogram_shards.shard(docs).select("shard").collect())
    assert len(got) == 16 and max(got.values()) <= 21


def test_redaction(spark):
    docs = spark.createDataFrame([(1, "mail a@b.co or +1 (555) 123-4567", 5, "x"), (2, None, 0, "y"), (3, "clean", 5, None)],
                                 "doc_id long, text string, n_chars long, spans string")
    got = {r.doc_id: r for r in anchor_pii.redact(docs).collect()}
    assert got[1].text == "mail <EMAIL> or <PHONE>" and got[1].n_chars == len(got[1].text)
    assert got[2].text is None and got[3].text == "clean" and got[3].spans is None


def test_addresses_and_accounts():
    def kinds(t):
        return [(k, t[a:b]) for k, found in anchor_pii.find(t.encode()).items() for a, b in found]

    assert kinds("at 221 North Baker Street.") == [("address", "221 North Baker Street")]
    assert kinds("Hauptstraße 12, Ort") == [("address", "Hauptstraße 12")]
    assert kinds("iban GB82WEST12345698765432 x") == [("account", "GB82WEST12345698765432")]
    assert kinds("iban GB82WEST12345698765433 x") == []
    assert kinds("the account of a street in the road, tokens and streets") == []


@pytest.mark.parametrize("address", [
    "12 Baker St", "12 Oak Ave", "4 King Rd", "1600 Penn Blvd", "3 Elm Ln", "8 Sunset Dr", "7 Long Way", "9 Fleet Court", "2 Fleet Ct", "1 Kings Place",
    "10 Trafalgar Square", "5 Union Sq", "6 Hill Terrace", "4 Park Crescent", "77 Coast Highway", "90 Lake Parkway", "Marktplatz 3", "Feldweg 12a", "Lindenallee 5",
    "Judengasse 7", "Hauptstr. 12", "12 avenue Victor Hugo", "5 place de la Concorde", "3 boulevard Voltaire", "Via Roma 12", "Viale Europa 3", "Corso Italia 9",
    "Avenida del Sol 44", "Paseo de Gracia 8", "Plaza Mayor 1", "25 Piazza Navona"])
def test_addresses_of_each_form(address):
    text = f"x: {address}, then"
    assert [text[a:b] for a, b in anchor_pii.find(text.encode())["address"]] == [address]


def test_street_words_that_are_other_words():
    for text in ["sent 5 via email", "in 2019 place the", "on the way 3 times", "in the place 12", "some 12 Ways", "deswegen 5", "3 Court orders", "the 1 st"]:
        assert anchor_pii.find(text.encode())["address"] == [], text


def test_account_values_reach_their_real_boundary():
    def accounts(t):
        return [t[a:b] for a, b in anchor_pii.find(t.encode())["account"]]

    long = "a1" * 100
    for text, value in [
            (f'token = "{long}" x', long), (f"token={long} x", long), ("token=eyJhbGc1.eyJzdWIi.c2ln x", "eyJhbGc1.eyJzdWIi.c2ln"),
            ("password=hunter2x!Zq9 x", "hunter2x!Zq9"), ("password: p@ss12345, x", "p@ss12345"), ("secret: !x?y$z9! x", "!x?y$z9!"),
            ('password = "two words 7" x', "two words 7"), ('{"token": "ab.cd-1234"}', "ab.cd-1234"), ("token='abc.1234 x", "abc.1234"),
            ("IBAN DE89 3704 0044 0532 0130 00 and", "DE89 3704 0044 0532 0130 00"), ("iban: ES91-2100-0418-4502-0005-1332.", "ES91-2100-0418-4502-0005-1332"),
            ("IBAN ES91 2100 0418 4502 0005 1332 BANK X", "ES91 2100 0418 4502 0005 1332"), ("account number: 1234 5678 9012 x", "1234 5678 9012"),
            ("iban gb82west12345698765432, x", "gb82west12345698765432"), ("SSN 123-45-6789.", "123-45-6789"), ("account no. 12345678.", "12345678"),
            ("account key-123456 x", "key-123456"), ("account no.ab12345 x", "ab12345"), ("token secret='a1b two 3' x", "a1b two 3"),
            ("secret: token=\"a1 b2c3\" x", "a1 b2c3"), ("account password=abc.12345", "abc.12345")]:
        assert accounts(text) == [value], text
        assert value not in anchor_pii.redact_text(text.encode()) and anchor_pii.redact_text(text.encode()).count("<ACCOUNT>") == 1
    for text in ["IBAN DE89 3704 0044 0532 0130 01 and", "the token of a 2024 book", "password: short", "account (see page 12345678)", "token 'the 3 kings'"]:
        assert accounts(text) == [], text
    assert accounts("token=" * 20_000) == [] and accounts("token=" * 20_000 + "ab1234") == ["ab1234"]


def _index(n=60, threshold=0.6):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(300)] + ["the", "of", "and"] * 40
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(9, 30))) + ". " + " ".join(rng.choice(vocabulary) for _ in range(4)))
             for i in range(n)]
    df = Counter(w for _, t in items for w in set(decontaminate.terms_of(t.encode())))
    mean = sum(len(decontaminate.terms_of(t.encode())) for _, t in items) / n
    return items, decontaminate.ItemIndex(items, n, mean, df, threshold)


@pytest.mark.parametrize("threshold", [0.05, 0.2, 0.6])
def test_block_max_wand_is_exhaustive_search(threshold):
    items, index = _index(threshold=threshold)
    weight = [{} for _ in index.ids]
    for t, (docs, ws) in enumerate(zip(index.lists, index.weights)):
        for d, w in zip(docs, ws):
            weight[d][t] = w
    rng = random.Random(9)
    for _ in range(150):
        terms = sorted(rng.sample(range(len(index.lists)), rng.randrange(1, 80)))
        expected = {d: sum(w[t] for t in terms if t in w) for d, w in enumerate(weight)}
        expected = {d: round(s, 9) for d, s in expected.items() if s >= threshold - 1e-9}
        assert {d: round(s, 9) for d, s in index.retrieve(terms)} == expected


def test_block_bounds_lose_no_passage():
    items, index = _index()
    rng = random.Random(2)
    texts = []
    for _ in range(30):
        filler = " ".join(rng.choice(["the", "of", "w1", "zz", "yy"]) for _ in range(rng.randrange(0, 200)))
        texts.append((filler + " " + rng.choice(items)[1].upper() + ", " + filler).encode())
    for raw, hits in zip(texts, index.leaks(texts)):
        low = raw.decode().lower()
        assert {items[s][0] for s in hits} >= {i for i, t in items if t in low}


def test_benchmark_in_blocks(spark, llm_dir):
    docs, items = spark.read.parquet(f"{llm_dir}/documents.parquet"), spark.read.parquet(f"{llm_dir}/benchmark.parquet")
    one = sorted(tuple(r)[:2] for r in decontaminate.leaks(docs, items).where("doc_id is not null").collect())
    many = sorted(tuple(r)[:2] for r in decontaminate.leaks(docs, items, block_bytes=200).where("doc_id is not null").collect())
    assert one == many and one
    clean = decontaminate.keep_clean(docs, items)
    assert clean.columns == docs.columns
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in docs.collect()} - {d for d, _ in one}


@pytest.mark.parametrize("step_bytes", [1, 5_000, 1 << 23])
def test_index_blocks_in_files_are_the_broadcast_index(spark, monkeypatch, step_bytes):
    """Repeated items, items with one id or none, short and empty ones: the
    same rows from blocks in the shared folder, in one scan of the documents."""
    monkeypatch.setattr(decontaminate.Stored, "step_bytes", step_bytes)
    rng = random.Random(8)
    items = [(f"i{i // 2}", " ".join(f"w{rng.randrange(60)}" for _ in range(n)) + ". The last answer is here.") for i, n in enumerate([5, 9, 14, 30, 70, 150])]
    items += [items[2], items[2], (None, items[3][1]), ("", items[4][1]), ("e", ""), ("n", None), ("s", "seldom seen"), ("p", "?!")]
    texts = [(d, f"w1 w2 {rng.choice(items)[1] or ''} w3 " * rng.randrange(3)) for d in range(40)] + [(None, items[3][1]), (7, None), (50, "Seldom, seen!")]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id string, text string")

    def rows(**more):
        return sorted(((*tuple(r)[:3], *(round(x, 9) for x in tuple(r)[3:])) for r in decontaminate.leaks(docs, bench, **more).collect()), key=repr)

    one, many = rows(), rows(block_bytes=150)
    assert one == many and {i for _, i, *_ in one} >= {None, "", "s", "i1"}
    repeated = [r for r in one if r[1] == "i1"]
    assert repeated and all(repeated.count(r) >= 3 or items[3][1] in (dict(texts)[r[0]] or "") for r in repeated)
    kept = [sorted((r.doc_id or -1 for r in decontaminate.keep_clean(docs, bench, **more).collect())) for more in ({}, {"block_bytes": 150})]
    assert kept[0] == kept[1] == sorted(d or -1 for d, _ in texts if d not in {r[0] for r in one})
    plan = decontaminate.leaks(docs, bench, block_bytes=150)._jdf.queryExecution().toString()
    assert plan.split("== Physical Plan ==")[1].count("MapInArrow") == 1
    assert isinstance(decontaminate.item_indexes(bench, 150), decontaminate.Stored)
    assert decontaminate.leaks(docs, bench.limit(0)).count() == 0 and decontaminate.keep_clean(docs, bench.limit(0)).count() == len(texts)


def test_an_item_is_looked_for_in_spans_of_its_own_length(spark):
    """Another item's length, and the blocks, change no verdict: an item whose
    answer stands far from its question is not found because a long one exists."""
    question = "which of the seven rivers crosses the old stone bridge near the quiet harbour"
    answer = "The blue Orinoco tributary."
    short, filler = f"{question}? {answer}", " ".join(f"filler{i}" for i in range(120))
    docs = spark.createDataFrame([(1, f"x {short} y"), (2, f"{question} {filler} {answer}"), (3, filler), (4, " ".join(f"long{i}" for i in range(900)))],
                                 "doc_id long, text string")
    other = " ".join(f"long{i}" for i in range(900))
    few = [("a", short), ("b", "nothing like any of the documents in this table. Truly nothing.")]
    many = [*few, ("c", other)]

    def pairs(items, **more):
        return sorted((r.doc_id, r.item_id) for r in decontaminate.leaks(docs, spark.createDataFrame(items, "item_id string, text string"), **more).collect())

    assert pairs(few) == [(1, "a")]
    assert pairs(many) == pairs(many, block_bytes=100) == [(1, "a"), (4, "c")]
    assert {r.doc_id for r in decontaminate.keep_clean(docs, spark.createDataFrame(many, "item_id string, text string")).collect()} == {2, 3}


def test_leaks_against_brute_force(spark):
    """Scores, overlaps and passages of every document and item recomputed
    without index, bounds or skipping."""
    rng = random.Random(21)
    vocabulary = [f"w{i}" for i in range(200)] + ["the", "of", "and"] * 30
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(n)) + ". " + " ".join(rng.choice(vocabulary) for _ in range(4))) for i, n in enumerate([9, 11, 14, 20, 28, 40, 70, 150])]
    texts = []
    for i in range(40):
        item = rng.choice(items)[1].split()
        for _ in range(rng.randrange(len(item) // 3 + 1)):
            item[rng.randrange(len(item))] = rng.choice(vocabulary)
        texts.append((i, " ".join([*(rng.choice(vocabulary) for _ in range(rng.randrange(150))), *item, *(rng.choice(vocabulary) for _ in range(rng.randrange(150)))])))
    got = {(r.doc_id, r.item_id): (r.n_passages, round(r.bm25_score, 9), round(r.question_overlap, 9), round(r.answer_overlap, 9))
           for r in decontaminate.leaks(spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    cut = {i: decontaminate.terms_of(t.encode()) for i, t in items}
    df, average = Counter(w for ws in cut.values() for w in set(ws)), sum(map(len, cut.values())) / len(cut)
    expected = {}
    for d, t in texts:
        ws = decontaminate.terms_of(t.encode())
        for i, item in items:
            own = cut[i]
            weight = {w: math.log(1 + (len(items) - df[w] + 0.5) / (df[w] + 0.5)) * own.count(w) * 2.2 / (own.count(w) + 1.2 * (0.25 + 0.75 * len(own) / average)) for w in set(own)}
            half = 1 << len(own).bit_length()
            for start in range(0, max(1, len(ws) - half), half):
                passage = ws[start:start + 2 * half]
                score = sum(weight[w] for w in set(passage) if w in weight) / sum(weight.values())
                question, answer = decontaminate.split_item(item)
                wanted, there = decontaminate.shingles(question), {b" ".join(passage[k:k + min(5, len(question))]) for k in range(len(passage))}
                q, a = len(wanted & there) / len(wanted), len(set(answer) & set(passage)) / len(set(answer))
                if score >= 0.6 - 1e-9 and q >= 0.6 and a >= 0.6:
                    old = expected.get((d, i), (0, 0, 0, 0))
                    expected[d, i] = (old[0] + 1, round(max(old[1], score), 9), round(max(old[2], q), 9), round(max(old[3], a), 9))
    assert got == expected and len(expected) > 15


def test_ring_links_connect_what_hamming_connects(spark):
    rng = random.Random(4)
    fps = set()
    for _ in range(25):
        b = rng.getrandbits(64)
        for _ in range(20):
            x = b
            for _ in range(rng.randrange(4)):
                x ^= 1 << rng.randrange(64)
            fps.add(x)
    dense = rng.getrandbits(64)
    fps |= {dense ^ rng.getrandbits(11) for _ in range(900)}  # more than PAIRWISE comparisons under one key
    fps = sorted(fps)
    signed = [int(np.uint64(x).view(np.int64)) for x in fps]
    prepare(spark)
    df = spark.createDataFrame([(s,) for s in signed], "fp long").repartition(3)
    root = {r.node: r.root for r in simhash_ring.components(simhash_ring.links(df)).collect()}
    groups: dict[int, set[int]] = {}
    for s in signed:
        groups.setdefault(root.get(s, s), set()).add(s)
    a = np.array(fps, np.uint64)
    label = np.arange(len(a))
    for _ in range(len(a)):
        new = np.array([label[np.bitwise_count(a ^ x) <= 2].min() for x in a])
        new = np.minimum(new, new[new])
        if (new == label).all():
            break
        label = new
    expected: dict[int, set[int]] = {}
    for s, g in zip(signed, label):
        expected.setdefault(int(g), set()).add(s)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_near_dedup_keeps_one(spark, llm_dir, doc_rows):
    docs = spark.read.parquet(f"{llm_dir}/documents.parquet")
    kept = simhash_ring.keep_one(docs)
    assert kept.columns == docs.columns
    judged = simhash_ring.near_duplicates(docs).collect()
    smallest = {}  # components by brute force over the fingerprints
    left = {r.fingerprint for r in judged}
    while left:
        group, more = set(), {left.pop()}
        while more:
            group |= more
            more = {f for f in left if any((int(f, 16) ^ int(g, 16)).bit_count() <= 2 for g in more)}
            left -= more
        ids = [r.doc_id for r in judged if r.fingerprint in group]
        smallest[min(group)] = min((i for i in ids if i is not None), default=None)
    assert Counter(r.doc_id for r in kept.collect()) == Counter(smallest.values())
    of = {}
    for r in simhash_ring.near_duplicates(kept).collect():
        of.setdefault(r.fingerprint, []).append(r.doc_id)
    assert all(len(v) == 1 for v in of.values())


def test_near_dedup_keeps_one_of_rows_without_or_with_one_id(spark):
    texts = {"a": "one two three four five six seven", "b": "quite another text about stones and rivers"}
    rows = [(None, texts["a"], 1), (None, texts["a"], 2), (7, texts["b"], 3), (7, texts["b"], 4), (7, texts["a"], 5), (9, texts["b"], 6), (None, None, 7), (None, "", 8)]
    kept = simhash_ring.keep_one(spark.createDataFrame(rows, "doc_id long, text string, row int").coalesce(1)).collect()
    assert sorted((r.doc_id or -1, r.text or "", r.row) for r in kept) == [(-1, "", 7), (7, texts["a"], 5), (7, texts["b"], 3)]


def test_log_ratio_separates(spark):
    rng = random.Random(8)
    good = [(i, " ".join(rng.choice(["the", "river", "stone", "walked", "quiet"]) + str(rng.randrange(30)) for _ in range(80))) for i in range(40)]
    junk = [(100 + i, " ".join("zz%d | |" % rng.randrange(30) for _ in range(60))) for i in range(20)]
    docs = spark.createDataFrame(good + junk, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 40, 2)], "doc_id long, quality int, toxic int")
    ratio = quality_llr.fit(docs, labels)
    kept = {r.doc_id: r.kept for r in quality_llr.judge(docs, ratio, ["doc_id"]).collect()}
    assert all(kept[i] for i, _ in good) and not any(kept[i] for i, _ in junk)
    assert (quality_llr.fit(docs, labels.limit(0)) == 0).all()


def test_quality_of_a_text_does_not_fall_with_its_copies(spark):
    """Many unlabelled copies of one clean text: it is scored as one text and
    kept, and so are the trusted documents; junk still goes."""
    rng = random.Random(9)

    def clean(i):
        return i, " ".join(rng.choice(["the", "river", "stone", "walked", "quiet"]) + str(rng.randrange(300)) for _ in range(150))

    good = [clean(i) for i in range(300)]
    hot = clean(500)[1]
    junk = [(600 + i, " ".join("zz%d | |" % rng.randrange(30) for _ in range(60))) for i in range(40)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(200)], "doc_id long, quality int, toxic int")

    def judged(copies):
        docs = spark.createDataFrame(good + junk + [(1000 + k, hot) for k in range(copies)], "doc_id long, text string").repartition(4)
        return {r.doc_id: r for r in quality_llr.judge(docs, quality_llr.fit(docs, labels), ["doc_id"]).collect()}

    one, many = judged(1), judged(400)
    assert all(many[1000 + k].kept and many[1000 + k].llr_score == one[1000].llr_score for k in range(400))
    assert all(many[i].kept for i, _ in good) and not any(many[i].kept for i, _ in junk)


def test_toxic_documents_of_good_quality_go(spark):
    """Two toxic words among hundreds reject a document, labelled or not, with
    punctuation or capitals; one mention does not."""
    rng = random.Random(10)

    def text(*more):
        ws = [rng.choice(["the", "river", "stone", "walked", "quiet"]) + str(rng.randrange(99)) for _ in range(300)]
        for w in more:
            ws.insert(rng.randrange(len(ws)), w)
        return " ".join(ws)

    clean = [(i, text()) for i in range(120)]
    toxic = [(200 + i, text("Scum,", "moron!") if i % 2 else text("you-moron", "SCUM")) for i in range(30)]
    once = [(300 + i, text("moron")) for i in range(5)]
    labels = [(i, 1, 0) for i in range(100)] + [(200 + i, 1, 1) for i in range(20)]
    docs = spark.createDataFrame(clean + toxic + once, "doc_id long, text string").repartition(3)
    ratio = quality_llr.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    of_word = quality_llr.WordValues(ratio.toxic.values)
    assert min(of_word[b"scum"], of_word[b"moron"]) > 2 > max(of_word[b"river7"], of_word[b"stone3"])
    kept = {r.doc_id for r in quality_llr.judge(docs, ratio, ["doc_id"]).where("kept").collect()}
    assert kept == {i for i, _ in clean + once}
    assert {r.doc_id for r in quality_llr.keep(docs, ratio).collect()} == kept


def test_toxic_words_of_many_forms(spark):
    """Labels teach the beginning of compound words: held-out documents with
    forms never labelled go, clean ones stay."""
    rng = random.Random(12)
    ends = ["heit", "ung", "lich", "ver", "pf", "keit", "er", "sch", "ä", "ß", "bar", "los", "ein", "um"]

    def text(bad):
        ws = [rng.choice(["der", "die", "und", "mit", "nicht", "fluss", "stein"]) + "".join(rng.choices(ends, k=rng.randrange(3))) for _ in range(rng.randrange(150, 600))]
        for _ in range(bad):
            ws.insert(rng.randrange(len(ws)), "grauslump" + "".join(rng.choices(ends, k=3)))
        return " ".join(ws)

    clean, toxic = [(i, text(0)) for i in range(400)], [(1000 + i, text(4)) for i in range(120)]
    labels = [(i, 1, 0) for i in range(200)] + [(1000 + i, 1, 1) for i in range(60)]
    docs = spark.createDataFrame(clean + toxic, "doc_id long, text string").repartition(3)
    ratio = quality_llr.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    kept = {r.doc_id for r in quality_llr.judge(docs, ratio, ["doc_id"]).where("kept").collect()}
    assert len(kept & set(range(200, 400))) >= 198 and len(kept & set(range(1060, 1120))) <= 3


def test_quality_against_brute_force(spark):
    """Score, toxic score, both cut-offs and the verdict recomputed in plain
    Python, over repeated texts, NULL ids and texts, and repeated labels."""
    rng = random.Random(13)

    def text(n, *more):
        ws = [rng.choice(["the", "river,", "Stone", "walked", "quiet."]) + str(rng.randrange(60)) for _ in range(n)]
        for w in more:
            ws.insert(rng.randrange(len(ws)), w)
        return " ".join(ws)

    rows = [(i, text(rng.randrange(60, 200))) for i in range(80)] + [(100 + i, text(90, "Scum,", "moron!", "(scummy)")) for i in range(14)]
    rows += [(200 + i, " ".join("zz%d | |" % rng.randrange(30) for _ in range(60))) for i in range(10)]
    rows += [(300, rows[3][1]), (301, rows[3][1]), (None, rows[4][1]), (None, None), (302, ""), (303, "few words"), (304, "... " * 60), (3, rows[3][1])]
    labels = [(i, 1, 0) for i in range(0, 60)] + [(100 + i, 1, 1) for i in range(8)] + [(300, 1, None), (None, 1, 1), (5, 1, 0), (200, 0, 0), (108, None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    ratio = quality_llr.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    got = quality_llr.judge(docs, ratio, ["doc_id", "text"]).collect()

    def unsigned(h):
        return np.array([h], np.uint64)

    def grams(t):
        hashes = [xxhash.xxh64_intdigest(w, quality_llr.SEED) for w in (t or "").encode().lower().split()]
        pairs = [int(pair_hash(unsigned(a), unsigned(b))[0]) for a, b in zip(hashes, hashes[1:])]
        return Counter(h % quality_llr.BUCKETS for h in hashes + pairs)

    def failed(t):
        ws = (t or "").split()
        three = Counter(tuple(ws[k:k + 3]) for k in range(len(ws) - 2))
        again = {k + d for k in range(len(ws) - 2) if three[tuple(ws[k:k + 3])] > 1 for d in range(3)}
        return len(ws) < 50 or 100 * len(again) > 50 * len(ws)

    def ratio_of(up, down, a, buckets, own=None):
        u, d = sum(up.values()), sum(down.values())
        more = a * d / u
        less_u = own[0] if own and own[1] is up else Counter()
        less_d = own[0] if own and own[1] is down else Counter()
        return lambda b: (math.log((up[b] - less_u[b] + a) / (u - sum(less_u.values()) + a * buckets))
                          - math.log((down[b] - less_d[b] + more) / (d - sum(less_d.values()) + more * buckets)))

    def mean(counts, f):
        return sum(n * f(b) for b, n in counts.items()) / sum(counts.values())

    good = {i for i, q, t in labels if q == 1 and t == 0 and i is not None}
    every = {t for _, t in rows if (t or "").strip()}
    trusted = {t for i, t in rows if i in good}
    raw, target = sum(map(grams, every), Counter()), sum(map(grams, trusted), Counter())
    score = ratio_of(target, raw, quality_llr.SMOOTHING, quality_llr.BUCKETS)
    own = [mean(grams(t), ratio_of(target, raw, quality_llr.SMOOTHING, quality_llr.BUCKETS, (grams(t), target))) for t in sorted(trusted) if not failed(t)]
    low = np.percentile(own, [1, 5])
    cut = min(0.0, low[0] - quality_llr.MARGIN * (low[1] - low[0]))
    assert math.isclose(ratio.threshold, cut, rel_tol=1e-9)

    def bare(t):
        return [w.encode() for w in re.split(r"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", (t or "").lower()) if w]

    def features(ws):
        return Counter(f for w in ws for f in quality_llr.word_features(w, quality_llr.TOXIC_BUCKETS))

    def top(ws, f):
        return sum(sorted(max(map(f, quality_llr.word_features(w, quality_llr.TOXIC_BUCKETS))) for w in ws)[-3:-1]) / 2

    bad = {i for i, _, t in labels if t == 1 and i is not None}
    fine = {i for i, _, t in labels if t == 0 and i is not None} - bad
    bad_texts = {t for i, t in rows if i in bad}
    fine_texts = {t for i, t in rows if i in fine} - bad_texts
    up, down = (sum((features(bare(t)) for t in ts), Counter()) for ts in (bad_texts, fine_texts))
    args = up, down, quality_llr.TOXIC_SMOOTHING, quality_llr.TOXIC_BUCKETS
    scored = [(top(bare(t), ratio_of(*args, (features(bare(t)), down))), math.log(len(bare(t)))) for t in sorted(fine_texts) if len(bare(t)) >= 50]
    s, x = map(np.array, zip(*scored))
    slope = ((s - s.mean()) * (x - x.mean())).mean() / x.var()
    toxic_cut = np.percentile(s - slope * x, 99.9)
    assert math.isclose(ratio.toxic.slope, slope, rel_tol=1e-6) and math.isclose(ratio.toxic.threshold, toxic_cut, rel_tol=1e-9)
    toxic = ratio_of(*args)
    assert len(got) == len(rows)
    for r in got:
        n = grams(r.text)
        assert (r.llr_score is None) == (not n) and (not n or math.isclose(r.llr_score, mean(n, score), rel_tol=1e-9, abs_tol=1e-12))
        ws = bare(r.text)
        value = top(ws, toxic) - slope * math.log(len(ws)) if ws else None
        assert (r.toxic_score is None) == (value is None) and (value is None or math.isclose(r.toxic_score, value, rel_tol=1e-6))
        assert r.kept == (not failed(r.text) and r.llr_score >= cut and (value is None or value <= toxic_cut))
    assert {r.doc_id for r in got if r.kept} >= {30, 31, 300, 301, None} and not {r.doc_id for r in got if r.kept} & set(range(100, 114))


def test_short_benchmark_items_are_found_whole(spark):
    items = spark.createDataFrame([(1, "Which green lamp? Stone."), (2, ""), (3, "word " * 3 + "end")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "Once: which GREEN lamp? Stone. Then which green lamp? stone"), (2, "which green lamp, then stone"),
                                  (3, "green lamp"), (4, None), (5, "a word word word end")], "doc_id long, text string")
    got = {(r.doc_id, r.item_id): (r.n_passages, r.question_overlap, r.answer_overlap) for r in decontaminate.leaks(docs, items).collect()}
    assert got == {(1, 1): (2, 1.0, 1.0), (5, 3): (1, 1.0, 1.0)}
    assert {r.doc_id for r in decontaminate.keep_clean(docs, items).collect()} == {2, 3, 4}


def test_page_text_after_an_unclosed_silent_element():
    def text(page):
        return warc_derive.read_page(page)[0]

    for tag in ("noscript", "template", "iframe"):
        assert text(f"<p>a</p><{tag}><p>gone</p></{tag}><p>b</p>") == "a\nb"
        assert text(f"<p>a</p></{tag}><p>b</p>") == "a\nb"
    for tag in ("noscript", "template"):
        assert text(f"<p>a</p><{tag}><img><p>whole body</p>") == "a\nwhole body"
        assert text(f"<p>a</p><{tag}><p>b</p><{tag}>gone</{tag}><p>c") == "a\nb\nc"
    assert "whole body" in text("<p>a</p><iframe src=x><p>whole body</p>")
    assert text("<p>a<template><noscript>x</template>b</noscript>c") == "abc"
    assert text("<p>a</p><script>var x") == "a"
    assert warc_derive.read_page("<noscript><title>T</title><p>b")[:2] == ("b", "T")


def test_warc_records_and_files(spark, llm_dir, tmp_path):
    pages = spark.read.parquet(f"{llm_dir}/pages.parquet")
    source = warc_derive.responses(pages)
    built = warc_derive.derivatives(source)
    rows = built.collect()
    originals = {warc_derive.parse(bytes(r.record))[0]["warc-record-id"]: warc_derive.parse(bytes(r.record)) for r in source.collect()}
    for r in rows:
        head, block = warc_derive.parse(bytes(r.record))
        source_head, _ = originals[head["warc-refers-to"]]
        assert head["warc-type"] == r.record_type and head["warc-block-digest"] == warc_derive.digest(block) == r.block_digest
        assert head["warc-source-payload-digest"] == source_head["warc-payload-digest"]
        assert head.get("warc-target-uri") == source_head.get("warc-target-uri")
        assert head["warc-date"] == source_head["warc-date"] and len(block) == r.content_length
    text = [warc_derive.parse(bytes(r.record))[1].decode() for r in rows if r.record_type == "conversion" and r.target_uri == "http://a.example/x"]
    assert "One\ntwo three" in text
    folder = str(tmp_path / "warc")
    warc_derive.write_files(built, folder)
    found = []
    for f in glob.glob(f"{folder}/*.gz"):
        data = gzip.open(f).read()
        while data:
            head, block = warc_derive.parse(data)
            size = data.index(b"\r\n\r\n") + 4 + len(block) + 4
            found.append(data[:size])
            data = data[size:]
    assert sorted(found) == sorted(bytes(r.record) for r in rows)
    assert warc_derive.derive(bytes(rows[0].record)) == []


def test_working_folder_is_the_configured_one(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        assert work_path(spark, "x").startswith(root.rstrip("/") + "/")
    assert work_path(spark, "x") != work_path(spark, "x")
