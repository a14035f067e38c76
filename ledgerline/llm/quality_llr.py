"""Quality rules: hashed n-gram log-likelihood ratio.

Two multinomials over hashed word n-grams (one and two lower-cased words,
``buckets`` buckets) are counted: one over the trusted target (labelled
documents of good quality that are not toxic), one over the whole raw corpus.
Exact copies share the weight of one text, so no text moves the multinomials
by being repeated. A document's score is the mean over its n-grams of
log p_target / p_raw, so its length does not matter; it is kept when the score
reaches a cut-off taken from the trusted documents' own scores. Plain rules
(word count, repetition) come first.

A mean over hundreds of n-grams hides a few toxic words, so a second ratio of
the same kind, toxic against not toxic labelled texts, is taken over hashed
words and word beginnings (which inflected and compound words share). A word's
value is the largest of its features; a document's is the mean of the second
and third highest word, so that no single word decides, less what a clean text
of its length reaches. Its cut-off comes from the clean labelled texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Noted, WordHasher, materialise, pair_hash, prepare, texts_of

BUCKETS = 1 << 16
#: Pseudo-count per bucket, in target n-grams; the raw counts get the same one
#: scaled to the raw total, so a bucket that is rare in both says little.
SMOOTHING = 10.0
SEED = 7
#: Trusted labels used at most (the ones with the smallest hash of the id);
#: the raw corpus is always counted whole.
MAX_TRUSTED = 20_000
#: The cut-off lies so many times the distance between the trusted texts' 1st
#: and 5th percentile below the 1st, and never above 0 (as in the raw corpus).
MARGIN = 5.0
#: Toxic ratio: buckets, pseudo-count per bucket (in toxic features), and the
#: lengths in bytes of the word beginnings beside the whole word.
TOXIC_BUCKETS = 1 << 18
TOXIC_SMOOTHING = 2.0
BEGINNINGS = (4, 5, 6, 7)
#: The cut-off is this quantile of the clean labelled texts' own scores. Fewer
#: toxic texts than this give no toxic ratio.
TOXIC_QUANTILE = 0.999
TOXIC_TEXTS = 5
#: Labels of either kind used at most; words a task remembers.
MAX_TOXIC = 20_000
WORDS_KEPT = 400_000
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

_WHITE = b" \t\n\x0b\x0c\r"
_SYMBOLS = b"#*$%&|<>"
_ASCII_MARKS = bytes(32 if c < 128 and not chr(c).isalnum() else c for c in range(256))


def trusted_ids(labels: DataFrame, limit: int = MAX_TRUSTED) -> DataFrame:
    """At most ``limit`` ids of documents labelled good and not toxic, in an
    order that depends on the ids alone. NULL ids or labels are not trusted."""
    good = labels.where((F.col("quality") == 1) & (F.col("toxic") == 0) & F.col("doc_id").isNotNull())
    ids = good.select(F.col("doc_id").alias("__trusted_id")).distinct()
    return ids.orderBy(F.xxhash64("__trusted_id"), "__trusted_id").limit(limit)


def _ngrams(hasher: WordHasher, words: list[bytes], buckets: int) -> np.ndarray:
    """Bucket of each one- and two-word n-gram of a document."""
    if not words:
        return np.zeros(0, np.int64)
    ids = hasher.ids(words)
    return _gram_buckets(hasher.hashes()[ids], buckets)


def _gram_buckets(one: np.ndarray, buckets: int) -> np.ndarray:
    both = np.concatenate([one, pair_hash(one[:-1], one[1:])])
    return (both % np.uint64(buckets)).astype(np.int64)


class Ratio(np.ndarray):
    """log p_target / p_raw per bucket, with the cut-off and the toxic ratio
    of the same fit."""

    threshold = 0.0
    toxic: ToxicRatio | None = None


@dataclass
class ToxicRatio:
    """log p_toxic / p_clean per bucket, growth of a clean text's score with
    the logarithm of its words, and cut-off."""

    values: np.ndarray
    slope: float = 0.0
    threshold: float = float("inf")

    def score(self, of_word: WordValues, words: list[bytes]) -> float:
        return self.scaled(of_word.of(words), len(words))

    def scaled(self, values: np.ndarray, n: int) -> float:
        """Score of ``n`` words, of whose values the highest are given."""
        return highest(values) - self.slope * float(np.log(n))


class WordValues(dict):
    """Word -> its value under a toxic ratio; emptied between texts when it
    holds ``WORDS_KEPT`` words."""

    def __init__(self, values: np.ndarray):
        super().__init__()
        self.values, self.buckets = values.tolist(), len(values)

    def __missing__(self, word: bytes) -> float:
        value = self[word] = max(map(self.values.__getitem__, word_features(word, self.buckets)))
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > WORDS_KEPT:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.float64, len(words))


class WordTable:
    """Words as numbers, each with the hash of its lower-cased form and what
    the toxic ratio makes of the bare words in it: how many there are, and the
    three highest values (more of one word cannot count). A text is looked up
    once for all rules. Emptied between texts when it holds ``limit`` words;
    results do not depend on it."""

    def __init__(self, toxic: ToxicRatio | None, limit: int = WORDS_KEPT):
        self.of_word = WordValues(toxic.values) if toxic else None
        self.limit = limit
        self._restart()

    def _restart(self) -> None:
        self.number = Noted()
        self.hashes, self.bare, self.highest = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros((0, 3))

    def ids(self, words: list[bytes]) -> np.ndarray:
        if len(self.number) > self.limit:
            self._restart()
        found = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
        if self.number.fresh:
            self._learn(len(self.number) - len(self.number.fresh))
        return found

    def _learn(self, done: int) -> None:
        fresh, total = self.number.fresh, len(self.number)
        if total > len(self.hashes):
            size = max(total, 2 * len(self.hashes), 1024)
            self.hashes, self.bare = np.resize(self.hashes, size), np.resize(self.bare, size)
            self.highest = np.resize(self.highest, (size, 3))
        digest = xxhash.xxh64_intdigest
        self.hashes[done:total] = np.fromiter((digest(w.lower(), SEED) for w in fresh), np.uint64, len(fresh))
        if self.of_word is not None:
            self.bare[done:total] = 0
            self.highest[done:total] = -np.inf
            for number, word in enumerate(fresh, done):
                values = sorted(map(self.of_word.__getitem__, _bare_words(word)), reverse=True)
                self.bare[number] = len(values)
                self.highest[number, :len(values[:3])] = values[:3]
            if len(self.of_word) > self.limit:
                self.of_word.clear()
        fresh.clear()

    def ngrams(self, ids: np.ndarray, buckets: int) -> np.ndarray:
        """``_ngrams`` of the lower-cased words."""
        return _gram_buckets(self.hashes[ids], buckets)

    def toxicity(self, toxic: ToxicRatio, ids: np.ndarray) -> float | None:
        """Toxic score of a text, None without a bare word."""
        n = int(self.bare[ids].sum())
        values = self.highest[ids].reshape(-1)
        return toxic.scaled(values[values > -np.inf], n) if n else None


def word_features(word: bytes, buckets: int) -> list[int]:
    """Buckets of a word and of its beginnings."""
    digest = xxhash.xxh64_intdigest
    return [digest(word, SEED) % buckets, *(digest(word[:k], SEED + 1) % buckets for k in BEGINNINGS if k < len(word))]


def highest(values: np.ndarray) -> float:
    """Mean of the second and third highest value; missing ones are zero."""
    if len(values) > 3:
        values = np.partition(values, len(values) - 3)[-3:]
    return float(np.sort(values)[:-1].sum()) / 2


def _distinct_texts(rows: DataFrame) -> DataFrame:
    """Each text of ``rows`` (``__text``, ``__flag``) once, packed, with the
    largest flag of its copies. Texts without words are left out.

    Copies meet by digest, first inside a batch and a task, so a text that
    fills much of the corpus is one row per task."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd")
        for batch in batches:
            found: dict[bytes, list] = {}
            for text, flag in zip(texts_of(batch, "__text"), batch.column("__flag").to_pylist(), strict=True):
                if not text.strip():
                    continue
                digest = hashlib.md5(text, usedforsecurity=False).digest()
                if digest not in found:
                    found[digest] = [None, len(text), codec.compress(text, asbytes=True)]
                if flag is not None:
                    found[digest][0] = max(flag, found[digest][0] or 0)
            flags, sizes, packed = zip(*found.values(), strict=True) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.binary()), pa.array(flags, pa.int32()), pa.array(sizes, pa.int64()), pa.array(packed, pa.binary())],
                ["digest", "flag", "size", "packed"])

    return (rows.mapInArrow(pack, "digest binary, flag int, size long, packed binary").groupBy("digest")
            .agg(F.max("flag").alias("flag"), F.first("size").alias("size"), F.first("packed").alias("packed")))


def fit(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, smoothing: float = SMOOTHING,
        max_trusted: int = MAX_TRUSTED) -> Ratio:
    """log p_target / p_raw per bucket (``buckets`` numbers, the only thing
    that reaches the driver beside the cut-off). Without any trusted document
    all are zero."""
    spark = docs.sparkSession
    prepare(spark)
    # at most max_trusted ids: a proven size
    trusted = F.broadcast(trusted_ids(labels, max_trusted).select("__trusted_id", F.lit(1).alias("__flag")))
    source = docs.select(F.col("doc_id").alias("__doc"), F.col("text").alias("__text"))
    rows = source.join(trusted, F.col("__doc") == F.col("__trusted_id"), "left").select("__text", "__flag")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, codec = WordHasher(SEED), pa.Codec("zstd")
        raw, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for batch in batches:
            every, good = [], []
            for flag, size, packed in zip(*(batch.column(c).to_pylist() for c in ("flag", "size", "packed")), strict=True):
                text = codec.decompress(packed, size, asbytes=True)
                grams = _ngrams(hasher, text.lower().split(), buckets)
                every.append(grams)
                if flag:
                    good.append(grams)
            raw += np.bincount(np.concatenate(every), minlength=buckets) if every else 0
            target += np.bincount(np.concatenate(good), minlength=buckets) if good else 0
        used = np.flatnonzero(raw)
        if len(used):
            yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(raw[used]), pa.array(target[used])],
                                             ["bucket", "raw", "target"])

    counts = (_distinct_texts(rows).mapInArrow(count, "bucket long, raw long, target long").groupBy("bucket")
              .agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect())
    raw, target = np.zeros(buckets), np.zeros(buckets)
    for r in counts:
        raw[r["bucket"]], target[r["bucket"]] = r["raw"], r["target"]
    if target.sum():
        ratio = log_ratio(raw, target, smoothing).view(Ratio)
        ratio.threshold = _cut_off(source.join(trusted, F.col("__doc") == F.col("__trusted_id")).select("__text"),
                                   raw, target, smoothing)
    else:
        ratio = np.zeros(buckets).view(Ratio)
    ratio.toxic = fit_toxic(docs, labels)
    return ratio


def _cut_off(texts: DataFrame, raw: np.ndarray, target: np.ndarray, smoothing: float) -> float:
    """Cut-off by ``MARGIN`` from the scores of the trusted texts that pass
    the base rules, each text once however often it is repeated.

    A text is scored with its own n-grams taken out of the target, as if it
    had no label: its label alone must not raise the cut-off."""
    buckets = len(raw)
    more = smoothing * raw.sum() / target.sum()
    shared = texts.sparkSession.sparkContext.broadcast((target, np.log((raw + more) / (raw + more).sum())))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(SEED)
        others, log_q = shared.value
        total = others.sum() + smoothing * buckets
        for batch in batches:
            digests, scores = [], []
            for text in texts_of(batch, "__text"):
                if _base_rules(hasher, text.split())[1]:
                    continue
                grams = _ngrams(hasher, text.lower().split(), buckets)
                used, own = np.unique(grams, return_counts=True)
                ratio = np.log((others[used] - own + smoothing) / (total - len(grams))) - log_q[used]
                digests.append(hashlib.md5(text, usedforsecurity=False).digest())
                scores.append(float((ratio * own).sum() / len(grams)))
            yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(scores, pa.float64())], ["digest", "score"])

    once = texts.mapInArrow(score, "digest binary, score double").groupBy("digest").agg(F.min("score").alias("score"))
    low = once.agg(F.percentile("score", F.array(F.lit(0.01), F.lit(0.05))).alias("low")).first()["low"]
    return min(0.0, low[0] - MARGIN * (low[1] - low[0])) if low else 0.0


def _bare_words(text: bytes) -> list[bytes]:
    """Lower-cased words without ASCII punctuation."""
    return text.lower().translate(_ASCII_MARKS).split()


def fit_toxic(docs: DataFrame, labels: DataFrame, buckets: int = TOXIC_BUCKETS, smoothing: float = TOXIC_SMOOTHING,
              limit: int = MAX_TOXIC) -> ToxicRatio | None:
    """The toxic ratio from the labelled texts, each text once (toxic if any
    copy is labelled so); at most ``limit`` ids of either label, in an order
    that depends on the ids alone. Two counts per bucket reach the driver. None
    without enough toxic texts, or without a clean one of ``MIN_WORDS`` words."""
    prepare(docs.sparkSession)
    source = docs.select(F.col("doc_id").alias("__doc"), F.col("text").alias("__text"))
    flags = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)).groupBy(F.col("doc_id").alias("__label_id"))
             .agg(F.max("toxic").cast("int").alias("__flag")))
    order = [F.xxhash64("__label_id"), F.col("__label_id")]
    # at most 2 * limit ids: a proven size
    known = F.broadcast(flags.where("__flag = 1").orderBy(*order).limit(limit).union(flags.where("__flag = 0").orderBy(*order).limit(limit)))
    texts = materialise(_distinct_texts(source.join(known, F.col("__doc") == F.col("__label_id")).select("__text", "__flag")), "labelled-texts")
    if texts.where("flag = 1").count() < TOXIC_TEXTS:
        return None

    def unpacked(batch: pa.RecordBatch) -> Iterator[tuple[int, list[bytes]]]:
        codec = pa.Codec("zstd")
        for flag, size, packed in zip(*(batch.column(c).to_pylist() for c in ("flag", "size", "packed")), strict=True):
            words = _bare_words(codec.decompress(packed, size, asbytes=True))
            if words:
                yield flag, words

    def features(words: list[bytes]) -> np.ndarray:
        return np.fromiter((f for w in words for f in word_features(w, buckets)), np.int64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2, buckets), np.int64)
        for batch in batches:
            for flag, words in unpacked(batch):
                np.add.at(seen[flag], features(words), 1)
        used = np.flatnonzero(seen.sum(0))
        if len(used):
            yield pa.RecordBatch.from_arrays([pa.array(used), *(pa.array(s[used]) for s in seen)], ["bucket", "clean", "toxic"])

    clean, toxic = np.zeros(buckets), np.zeros(buckets)
    for r in (texts.mapInArrow(count, "bucket long, clean long, toxic long").groupBy("bucket")
              .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).toLocalIterator()):
        clean[r["bucket"]], toxic[r["bucket"]] = r["clean"], r["toxic"]
    if not clean.sum() or not toxic.sum():
        return None
    more = smoothing * clean.sum() / toxic.sum()
    log_p = np.log((toxic + smoothing) / (toxic.sum() + smoothing * buckets))
    shared = texts.sparkSession.sparkContext.broadcast((clean, log_p))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a clean text is scored with its own features taken out, as if it had no label
        clean, log_p = shared.value
        total = clean.sum() + more * buckets
        for batch in batches:
            scores, sizes = [], []
            for _, words in unpacked(batch):
                if len(words) < MIN_WORDS:
                    continue
                own = features(words)
                used, times = np.unique(own, return_counts=True)
                value = dict(zip(used.tolist(), (log_p[used] - np.log((clean[used] - times + more) / (total - len(own)))).tolist(), strict=True))
                scores.append(highest(np.array([max(map(value.__getitem__, word_features(w, buckets))) for w in words])))
                sizes.append(float(np.log(len(words))))
            yield pa.RecordBatch.from_arrays([pa.array(scores, pa.float64()), pa.array(sizes, pa.float64())], ["score", "size"])

    own = materialise(texts.where("flag = 0").mapInArrow(score, "score double, size double"), "clean-scores")
    fitted = own.agg(F.covar_pop("score", "size").alias("shared"), F.var_pop("size").alias("spread")).first()
    if fitted["spread"] is None:
        return None
    slope = fitted["shared"] / fitted["spread"] if fitted["spread"] else 0.0
    cut = own.agg(F.percentile(F.col("score") - F.lit(slope) * F.col("size"), F.lit(TOXIC_QUANTILE)).alias("cut")).first()["cut"]
    return ToxicRatio(log_p - np.log((clean + more) / (clean.sum() + more * buckets)), slope, cut)


def _base_rules(hasher: WordHasher, words: list[bytes]) -> tuple[int, bool]:
    """Repeated words of a text, and whether it fails the plain rules."""
    return _rules_of_ids(hasher.ids(words))


def _rules_of_ids(ids: np.ndarray) -> tuple[int, bool]:
    n = len(ids)
    repeat = repeated_words(ids) if n else 0
    return repeat, n < MIN_WORDS or 100 * repeat > MAX_REPEAT_PERCENT * n


def log_ratio(raw: np.ndarray, target: np.ndarray, smoothing: float) -> np.ndarray:
    """log of the smoothed target multinomial over the smoothed raw one."""
    more = smoothing * raw.sum() / target.sum()
    p = (target + smoothing) / (target + smoothing).sum()
    q = (raw + more) / (raw + more).sum()
    return np.log(p) - np.log(q)


def repeated_words(ids: np.ndarray) -> int:
    """Words inside a 3-word window that occurs at least twice in the text."""
    n = len(ids) - 2
    if n < 2:
        return 0
    if len(ids) and ids.max() >= 1 << 21:  # three numbers must fit one 63-bit key
        ids = np.unique(ids, return_inverse=True)[1]
    if ids.max() >= 1 << 21:
        _, inverse, counts = np.unique(np.stack([ids[:-2], ids[1:-1], ids[2:]], 1), axis=0,
                                       return_inverse=True, return_counts=True)
        again = counts[inverse.reshape(-1)] > 1
    else:
        key = ids[:-2] << 42 | ids[1:-1] << 21 | ids[2:]
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        again = np.zeros(n, bool)
        again[order[1:][same]] = True
        again[order[:-1][same]] = True
    covered = np.zeros(n + 2, bool)
    for shift in range(3):
        covered[shift:n + shift] |= again
    return int(covered.sum())


def duplicate_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    seen, again = set(), 0
    for line in text.split(b"\n"):
        if line.strip(_WHITE):
            if line in seen:
                again += 1
            seen.add(line)
    return again


def _code_points(data: bytes) -> int:
    return len(data.decode("utf-8"))


RULE_FIELDS = [("n_words", "long"), ("word_chars", "long"), ("n_symbols", "long"), ("n_dup_lines", "long"),
               ("n_repeat_words", "long"), ("base_failed", "boolean"), ("llr_score", "double"), ("toxic_score", "double"), ("kept", "boolean")]


def judge(docs: DataFrame, ratio_of_bucket: np.ndarray, keep: list[str], threshold: float | None = None) -> DataFrame:
    """One row per document: the ``keep`` columns and ``RULE_FIELDS``.

    NULL and empty texts have no words and fail the base rules; their score is
    NULL. ``toxic_score`` is NULL without a toxic ratio or a word that is more
    than punctuation. Repeated rows are judged alike; an empty table gives no
    rows. Without a ``threshold`` the cut-off of the fit holds."""
    names = [f"__k{i}" for i in range(len(keep))]
    found = _judged(docs, ratio_of_bucket, keep, names, threshold)
    for name, column in zip(names, keep, strict=True):
        found = found.withColumnRenamed(name, column)
    return found


def keep(docs: DataFrame, ratio_of_bucket: np.ndarray, threshold: float | None = None) -> DataFrame:
    """The documents judged as kept, with all their columns."""
    columns = docs.columns
    names = [f"__k{i}" for i in range(len(columns))]
    kept = _judged(docs, ratio_of_bucket, columns, names, threshold).where("kept")
    return kept.select(*(F.col(n).alias(c) for n, c in zip(names, columns, strict=True)))


def _judged(docs: DataFrame, ratio_of_bucket: np.ndarray, keep: list[str], names: list[str], threshold: float | None) -> DataFrame:
    """``judge`` with the kept columns under other names, so that columns of
    ``docs`` may be called like the rules' own."""
    spark = docs.sparkSession
    prepare(spark)
    buckets = len(ratio_of_bucket)
    if threshold is None:
        threshold = getattr(ratio_of_bucket, "threshold", Ratio.threshold)
    # a fixed number of buckets in either ratio
    shared = spark.sparkContext.broadcast((np.asarray(ratio_of_bucket), getattr(ratio_of_bucket, "toxic", Ratio.toxic)))
    fields = [docs.schema[c] for c in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratio, toxic = shared.value
        known = WordTable(toxic)
        for batch in batches:
            out: list[list] = [[] for _ in RULE_FIELDS]
            for text in texts_of(batch, "__rule_text"):
                ids = known.ids(text.split())
                n = len(ids)
                repeat, failed = _rules_of_ids(ids)
                score = float(ratio[known.ngrams(ids, buckets)].mean()) if n else None
                good = not failed and score >= threshold
                toxicity = known.toxicity(toxic, ids) if toxic else None
                good = good and (toxicity is None or toxicity <= toxic.threshold)
                row = (n, _code_points(text.translate(None, _WHITE)), len(text) - len(text.translate(None, _SYMBOLS)),
                       duplicate_lines(text), repeat, failed, score, toxicity, good)
                for column, value in zip(out, row, strict=True):
                    column.append(value)
            kinds = {"long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64()}
            columns = [batch.column(i) for i in range(len(keep))]
            columns += [pa.array(v, kinds[k]) for v, (_, k) in zip(out, RULE_FIELDS, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, [*names, *(f for f, _ in RULE_FIELDS)])

    kinds = {"long": T.LongType(), "boolean": T.BooleanType(), "double": T.DoubleType()}
    schema = T.StructType([T.StructField(f"__k{i}", f.dataType) for i, f in enumerate(fields)]
                          + [T.StructField(f, kinds[k]) for f, k in RULE_FIELDS])
    source = docs.select(*(F.col(f"`{c}`").alias(n) for c, n in zip(keep, names, strict=True)), F.col("text").alias("__rule_text"))
    return source.mapInArrow(run, schema)
