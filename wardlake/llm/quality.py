"""Quality rules by distribution divergence.

A document's histograms (classes of characters; common words) are compared with those of its language by the
Jensen-Shannon distance. The references are counted over all documents of the language that pass the base rules,
common words being the most frequent ones of that count, and the share of a class of characters the median of the documents'
shares, which junk of a minority cannot move. Short texts have noisy histograms: a distance is used
only from a minimum length on, and the limit of the common words follows the distances that texts of the same length
drawn from the reference have.

A word of 40 characters or more counts among all words but is never one of the common ones: a language written with few
spaces has then no common words, and its documents are judged by their classes of characters alone.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wardlake.llm.common import stage, text_of

MIN_WORDS = 50
RANK_PARTS = 16
COMMON_WORDS = 64
#: What passes the base rules in a language, for its medians and its common words to be a reference.
LEAST_DOCUMENTS = 10
LEAST_WORDS = 2000
#: References of the languages with the most rows that every task holds; those of further languages are joined to their rows.
MAX_HELD = 1000
MAX_CHAR_DISTANCE = 0.15
#: The limit of the word distance: mean and NOISE standard deviations of texts of that length drawn from the reference,
#: at least LEAST_LIMIT of the distance of a text without common words. A limit beyond that distance could not reject;
#: such short texts are only rejected if they have no common word where that has a chance below NO_COMMON.
NOISE = 5
LEAST_LIMIT = 0.7
NO_COMMON = 1e-6
LENGTHS = [50, 70, 100, 140, 200, 280, 400, 800, 1600, 3200, 6400, 12800]
SHARE_STEPS = 2000
MIN_CHARS_FOR_CLASSES = 200
MIN_WORDS_FOR_COMMON = 50

WORDS = re.compile("[^ \t-\r]+").findall
SYMBOLS = "#*$%&|<>"
MARKS = "!?;:\"'()[]{}-_/\\+=@^~`"
CLASSES = ["lower", "upper", "other", "space", "stop", "mark", "symbol", "digit", "sign"]
DIGIT = CLASSES.index("digit")
#: So many digits, as a share of the text, count as lower: a number is no junk, a page of numbers is.
FREE_DIGITS = 0.1
EDGES = ".,;:!?\"'()[]{}#*$%&|<>"
_TABLE_SIZE = 0x20000


def _class_of(c: str) -> int:
    if c in " \t\n\x0b\x0c\r":
        return 3
    if c in ".,。，、．।۔،":
        return 4
    if c in SYMBOLS:
        return 6
    if c in MARKS:
        return 5
    if c.isupper():
        return 1
    if ord(c) < 0x250:
        return DIGIT if c.isnumeric() else 0 if c.isalpha() else 2
    kind = unicodedata.category(c)
    if kind == "Cf":  # joiners inside words
        return 0
    return {"L": 0, "M": 0, "N": DIGIT, "Z": 3, "P": 5}.get(kind[0], 8)


#: The class of each character of the first two planes; further ones are ideographs, tags (lower) or private (sign).
_CLASS = np.array([_class_of(chr(k)) for k in range(_TABLE_SIZE)] + [0, 8], np.uint8)


def char_classes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    if len(points) and points.max() >= _TABLE_SIZE:
        points = np.where(points >= 0xF0000, _TABLE_SIZE + 1, np.minimum(points, _TABLE_SIZE))
    n = np.bincount(_CLASS[points], minlength=len(CLASSES)).astype(np.int64)
    free = min(int(n[DIGIT]), int(FREE_DIGITS * len(points)))
    n[DIGIT] -= free
    n[0] += free
    return n


def class_shares(text: str) -> list[str]:
    """``class:share`` for each class, the share in steps of 1 / SHARE_STEPS."""
    n = char_classes(text)
    return [f"{c}:{s}" for c, s in zip(CLASSES, np.rint(n * SHARE_STEPS / max(1, n.sum())).astype(int).tolist())]


def repeated_words(words: list[str]) -> int:
    """Words that lie in a window of three words which the text holds twice or more."""
    if len(words) < 4:
        return 0
    ids: dict[str, int] = {}
    a = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    v = len(ids)
    pairs = a[:-1] * v + a[1:]
    if v > 2_000_000:  # keep the product below 2**63
        pairs = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
    keys = pairs[:-1] * v + a[2:]
    _, where, count = np.unique(keys, return_inverse=True, return_counts=True)
    twice = count[where] > 1
    hit = np.zeros(len(a), bool)
    hit[:-2] |= twice
    hit[1:-1] |= twice
    hit[2:] |= twice
    return int(hit.sum())


def base_counts(text: str, words: list[str]) -> tuple[int, int, int, int]:
    """word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    seen: set[str] = set()
    again = 0
    for line in text.split("\n"):
        if line.strip(" \t\n\x0b\x0c\r"):
            again += line in seen
            seen.add(line)
    return sum(map(len, words)), sum(map(text.count, SYMBOLS)), again, repeated_words(words)


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < MIN_WORDS or 100 * n_repeat_words > 50 * n_words


def plain_word(word: str) -> str:
    return word.strip(EDGES).lower()


def js_distance(p: np.ndarray, q: np.ndarray) -> float:
    """Square root of the Jensen-Shannon divergence to base 2 of two count vectors; 0 if either is empty."""
    if p.sum() == 0 or q.sum() == 0:
        return 0.0
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2

    def part(x):
        k = x > 0
        return float((x[k] * np.log2(x[k] / m[k])).sum())

    return max(0.0, (part(p) + part(q)) / 2) ** 0.5


def js_distances(rows: np.ndarray, q: np.ndarray) -> np.ndarray:
    """``js_distance`` of every row of counts and ``q``."""
    p, q = rows / rows.sum(axis=1, keepdims=True), q / q.sum()
    m = (p + q) / 2

    def part(x):
        return np.where(x > 0, x * np.log2(np.where(x > 0, x, 1) / np.where(m > 0, m, 1)), 0).sum(axis=1)

    return np.sqrt(np.maximum(0, (part(p) + part(np.broadcast_to(q, p.shape))) / 2))


class Reference:
    """One language: the class shares and the counts of its common words, the last of which is all other words.

    Empty ``classes`` or a ``total`` of 0: too few documents or words, and that distance is skipped.
    """

    def __init__(self, classes: list[float], words: list[tuple[str, int]], total: int):
        self.classes = np.array(classes or [0] * len(CLASSES), float)
        self.at = {w: k for k, (w, _) in enumerate(words)}
        self.words = np.array([n for _, n in words] + [max(0, total - sum(n for _, n in words))], float)
        self._limits: tuple[float, float, np.ndarray] | None = None

    def word_counts(self, words: list[str]) -> np.ndarray:
        out = np.zeros(len(self.words))
        other = len(self.at)
        for w, n in Counter(words).items():
            out[self.at.get(plain_word(w), other) if len(w) < 40 else other] += n
        return out

    def too_far(self, counts: np.ndarray, distance: float) -> bool:
        """Whether a text of these ``word_counts`` lies beyond the limit of its length."""
        if self.words.sum() == 0:
            return False
        if self._limits is None:  # worked out when the language is first met
            share = self.words / self.words.sum()
            rng = np.random.default_rng(0)
            drawn = [js_distances(rng.multinomial(n, share, 200), share) for n in LENGTHS]
            none = js_distance(np.eye(len(share))[-1], share)
            self._limits = none, float(share[-1]), np.array([d.mean() + NOISE * d.std() for d in drawn])
        none, rest, limits = self._limits
        n = counts.sum()
        limit = float(np.interp(np.log(n), np.log(LENGTHS), limits))
        if limit < none and distance > max(limit, LEAST_LIMIT * none):
            return True
        return counts[:-1].sum() == 0 and rest ** n < NO_COMMON


def judge(text: str, words: list[str], n_repeat: int, ref: Reference | None) -> tuple[float, float, bool]:
    """The two distances (0 where the text is too short for one) and whether the method keeps the text."""
    if ref is None:
        return 0.0, 0.0, True
    chars = js_distance(char_classes(text).astype(float), ref.classes) if len(text) >= MIN_CHARS_FOR_CLASSES else 0.0
    if len(words) < MIN_WORDS_FOR_COMMON:
        return chars, 0.0, chars <= MAX_CHAR_DISTANCE
    counts = ref.word_counts(words)
    common = js_distance(counts, ref.words)
    return chars, common, chars <= MAX_CHAR_DISTANCE and not ref.too_far(counts, common)


def _count(entries: int = 200_000):
    """Pass one: counts of rows, classes and words per language, combined inside the task and given out when the table is full."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[str | None, tuple[Counter, Counter, Counter]] = {}
        size = 0

        def out():
            lang, kind, key, n = [], [], [], []
            for la, (words, classes, rows) in kept.items():
                plain = Counter()
                for w, c in words.items():
                    plain[plain_word(w) if len(w) < 40 else ""] += c
                for kd, pairs in (("w", plain.items()), ("c", classes.items()), ("d", rows.items())):
                    for k, c in pairs:
                        lang.append(la)
                        kind.append(kd)
                        key.append(k)
                        n.append(c)
            kept.clear()
            return pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(kind, pa.string()),
                                               pa.array(key, pa.string()), pa.array(n, pa.int64())],
                                              names=["lang", "kind", "key", "n"])

        for b in batches:
            for la, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()):
                mine = kept.setdefault(la, (Counter(), Counter(), Counter()))
                size -= sum(map(len, mine))
                mine[2][""] += 1
                words = WORDS(text)
                if not base_failed(len(words), repeated_words(words)):
                    mine[0].update(words)
                    mine[1].update(class_shares(text))
                size += sum(map(len, mine))
                if size > entries:
                    yield out()
                    size = 0
        if kept:
            yield out()

    return run


def references(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """One short row per language, counted over every document that passes the base rules, and written.

    lang, known (false for a null language, whose lang is then empty), n_rows (all rows), classes (median shares in
    the order of CLASSES, empty under LEAST_DOCUMENTS documents), words and counts (the COMMON_WORDS most frequent,
    best first), total (all words, 0 under LEAST_WORDS).
    """
    rows = docs.select(F.col(lang_col).cast("string").alias("lang"), text_of(text_col).alias("text"))
    found = rows.mapInArrow(_count(), "lang string, kind string, key string, n long")
    keyed = found.select(F.coalesce("lang", F.lit("")).alias("lang"), F.col("lang").isNotNull().alias("known"), "kind", "key", "n")
    counts = stage(keyed.groupBy("lang", "known", "kind", "key").agg(F.sum("n").alias("n")), "quality-counts")
    value = F.lit(None).cast("double").alias("value")
    # ranked in two levels: the best of each of RANK_PARTS parts of the words, then the best of these
    common = counts.filter("kind = 'w' AND key <> ''").withColumn("part", F.pmod(F.xxhash64("key"), F.lit(RANK_PARTS)))
    for level in (["lang", "known", "part"], ["lang", "known"]):
        nth = F.row_number().over(W.partitionBy(*level).orderBy(F.desc("n"), "key"))
        common = common.withColumn("nth", nth).filter(F.col("nth") <= COMMON_WORDS).drop("nth")
    common = common.drop("part")
    total = counts.filter("kind <> 'c'").groupBy("lang", "known", F.when(F.col("kind") == "w", "t").otherwise("d").alias("kind")).agg(
        F.lit("").alias("key"), F.sum("n").alias("n"))
    share = F.split("key", ":")
    medians = counts.filter("kind = 'c'").select("lang", "known", "kind", share[0].alias("key"), share[1].cast("int").alias("share"), "n").groupBy(
        "lang", "known", "kind", "key").agg(F.sum("n").alias("n"), F.expr("percentile(share, 0.5, n)").alias("value"))
    parts = common.withColumn("value", value).unionByName(total.withColumn("value", value)).unionByName(medians)

    def of(kind, x):
        return F.when(F.col("kind") == kind, x)

    # COMMON_WORDS + len(CLASSES) + 2 rows a language
    one = parts.groupBy("lang", "known").agg(
        F.max(of("d", F.col("n"))).alias("n_rows"), F.coalesce(F.max(of("t", F.col("n"))), F.lit(0).cast("long")).alias("total"),
        F.coalesce(F.max(of("c", F.col("n"))), F.lit(0).cast("long")).alias("documents"),
        F.collect_list(of("c", F.struct("key", "value"))).alias("medians"),
        F.sort_array(F.collect_list(of("w", F.struct((-F.col("n")).alias("n"), "key")))).alias("common"))
    by_class = F.map_from_entries("medians")
    enough = F.col("total") >= LEAST_WORDS
    none = F.array().cast("array<double>")
    return stage(one.select(
        "lang", "known", "n_rows",
        F.when(F.col("documents") >= LEAST_DOCUMENTS, F.array(*(by_class[c] for c in CLASSES))).otherwise(none).alias("classes"),
        F.when(enough, F.col("common.key")).otherwise(F.array().cast("array<string>")).alias("words"),
        F.when(enough, F.transform("common.n", lambda n: -n)).otherwise(F.array().cast("array<bigint>")).alias("counts"),
        F.when(enough, F.col("total")).otherwise(0).alias("total")), "quality-references")


def _reference(r) -> Reference | None:
    return Reference(r["classes"], list(zip(r["words"], r["counts"])), r["total"]) if r["classes"] or r["total"] else None


def _each(rows: DataFrame, refs: DataFrame, work, schema: str | StructType) -> DataFrame:
    """``work(batch, references of its rows)`` over all batches of ``rows``, which have a column _lang.

    Every task holds the MAX_HELD references of the languages with the most rows. Rows of other languages, none of
    which has more than one in MAX_HELD rows, are joined to theirs.
    """
    top = refs.orderBy(F.desc("n_rows"), "lang", "known").limit(MAX_HELD).collect()
    held = {r["lang"] if r["known"] else None: _reference(r) for r in top}

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield work(b, [held.get(la) for la in b.column("_lang").to_pylist()])

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple = ()  # the join leaves the rows of a language together
        for b in batches:
            mine = []
            for k, la in enumerate(b.column("_lang").to_pylist()):
                if last[:1] != (la,):
                    r = b.column("_reference")[k].as_py()
                    last = la, r and _reference(r)
                mine.append(last[1])
            yield work(b, mine)

    if len(top) < MAX_HELD:
        return rows.mapInArrow(near, schema)
    here = F.coalesce(F.col("_lang").isin([la for la in held if la is not None]), F.lit(None in held))
    keys = refs.select(F.col("lang").alias("_l"), F.col("known").alias("_k"),
                       F.struct("classes", "words", "counts", "total").alias("_reference"))
    far = rows.filter(~here).join(keys, (F.coalesce("_lang", F.lit("")) == F.col("_l")) & (F.col("_lang").isNotNull() == F.col("_k")), "left")
    return rows.filter(here).mapInArrow(near, schema).union(far.drop("_l", "_k").mapInArrow(joined, schema))


def _judged(b: pa.RecordBatch, refs: list[Reference | None]) -> pa.RecordBatch:
    out: list[list] = [[] for _ in range(9)]
    for ref, text in zip(refs, b.column("_text").to_pylist()):
        words = WORDS(text)
        four = base_counts(text, words)
        chars, common, good = judge(text, words, four[3], ref)
        failed = base_failed(len(words), four[3])
        for column, value in zip(out, (len(words), *four, failed, good and not failed, chars, common)):
            column.append(value)
    kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()] * 2
    return pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(c, k) for c, k in zip(out, kinds))],
                                      names=["doc_id", *(x.split()[0] for x in _SCHEMA.split(", "))])


_SCHEMA = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
           "kept boolean, char_distance double, word_distance double")


def decisions(docs: DataFrame, id_col: str = "doc_id", lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs`` with its counts, both distances and the verdict.

    A null text has no words and fails the base rules, as every text under 50 words. Every language is held against
    its own reference, rows without a language against that of all of these. Where a language has too few documents or words
    for a reference, the distance is 0 and the other rules decide. An empty table gives no rows; other columns are not read.
    """
    refs = references(docs, lang_col, text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).cast("string").alias("_lang"),
                       text_of(text_col).alias("_text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return _each(rows, refs, _judged, f"doc_id {kind}, {_SCHEMA}")


def good_documents(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the rules keep, all columns as they were, whatever their names.

    A null text has no words and goes; a null language is one of its own; rows that repeat are judged alike and all
    stay or go; an empty table gives no rows.
    """
    refs = references(docs, lang_col, text_col)
    names = [f"c{k}" for k in range(len(docs.columns))]  # under these names the columns clash with none added here
    safe = docs.toDF(*names)
    lang, text = (names[docs.columns.index(c)] for c in (lang_col, text_col))

    def work(b: pa.RecordBatch, refs: list[Reference | None]) -> pa.RecordBatch:
        keep = []
        for ref, text in zip(refs, b.column("_text").to_pylist()):
            words = WORDS(text)
            n = repeated_words(words)
            keep.append(not base_failed(len(words), n) and judge(text, words, n, ref)[2])
        return b.select(names).filter(pa.array(keep, pa.bool_()))

    good = _each(safe.withColumn("_lang", F.col(lang).cast("string")).withColumn("_text", text_of(text)), refs, work, safe.schema)
    return good.toDF(*docs.columns)
