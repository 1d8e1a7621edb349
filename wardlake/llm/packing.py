"""Packing by concatenating all documents and cutting the stream into fixed windows.

Two passes. The first tokenizes every document where it lies and writes its
ids with the running total inside its partition. The totals of the partitions
(one short row each) then give every partition its place in the stream by a
prefix sum, and so every document its global offset. The second pass cuts each
document where it crosses a window of ``size`` ids; a document that crosses
leaves a boundary record in each window. No token is shuffled, and only the
last window is padded.
"""

from __future__ import annotations

import gc
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardlake.llm.common import stage, text_of

SIZE = 2048
END_ID = 1
VOCABULARY = "word_bpe_49k.json"
#: Entries of a worker's word tables; when full they start anew, which changes no result.
TABLE_ENTRIES = 500_000
#: Text that is cut into words at a time: its words take some ten times as much of a worker's memory.
BATCH_BYTES = 2_000_000


class WordTokenizer:
    """The ids of ``tokenizers`` for whole texts, through a table of words already seen.

    The vocabulary's pre-tokenizer drops white space and never joins across it, so a text's ids are the ids of its
    words. A word with characters from U+0250 on is given to the library as it stands. Other words are cut by
    the pre-tokenizer's own pattern here, and their distinct parts go to the library without its normalizer.
    With ``added`` the strings of added tokens (``<|endoftext|>``) inside a text are these tokens, as by the library's
    default; words that may hold one are given to the library. Otherwise they are ordinary text.
    """

    def __init__(self, path: str, entries: int = TABLE_ENTRIES, added: bool = False):
        import json
        import os
        import unicodedata

        import regex
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = not added
        with open(path) as f:
            spec = json.load(f)
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.parts_of = regex.compile(split["pattern"]["Regex"]).findall
        spec["normalizer"] = None
        spec["pre_tokenizer"]["pretokenizers"] = [
            {"type": "WhitespaceSplit"}, *(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] != "Split")]
        self.bare = Tokenizer.from_str(json.dumps(spec))
        self.bare.encode_special_tokens = True
        suffix = spec["model"]["end_of_word_suffix"]
        vocab = spec["model"]["vocab"]
        self.ends = np.zeros(max(self.whole.get_vocab(True).values()) + 1, bool)
        self.ends[[i for t, i in vocab.items() if t.endswith(suffix)]] = True
        self.kind = np.dtype("<u2") if len(self.ends) <= 1 << 16 else np.dtype("<u4")
        self.nfc = unicodedata.normalize
        names = [re.escape(t["content"]) for t in spec["added_tokens"]] if added else []
        self.foreign = re.compile("|".join(["[ɐ-\U0010ffff]", *names])).search
        self.words: dict[str, bytes] = {"": b""}
        self.parts: dict[str, bytes] = {}
        self.entries = entries

    def _cut(self, word: str) -> list[str]:
        """The pre-tokenizer's parts of a word, lower case."""
        low = word.lower()
        if low.isalpha():
            return [low]
        if word[-1] in ".," and low[:-1].isalpha():
            return [low[:-1], word[-1]]
        return self.parts_of(self.nfc("NFC", word).lower())

    def _learn(self, new: list[str]) -> None:
        """Fill the tables for words not in them."""
        if len(self.words) + len(new) > self.entries:
            self.words = {"": b""}
        if len(self.parts) > self.entries:
            self.parts = {}
        words, parts, cut = self.words, self.parts, self._cut
        foreign = [w for w in new if self.foreign(w)]
        for w, e in zip(foreign, self.whole.encode_batch_fast(foreign, add_special_tokens=False)):
            words[w] = np.array(e.ids, self.kind).tobytes()
        plain = [w for w in new if w not in words]
        unseen = list({p for w in plain for p in cut(w) if p not in parts})
        wide = self.kind.itemsize
        for k in range(0, len(unseen), 32):
            some = unseen[k:k + 32]
            ids = np.array(self.bare.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, self.kind)
            cuts = ((np.flatnonzero(self.ends[ids]) + 1) * wide).tolist()
            if len(cuts) != len(some):  # a part that holds the mark of a word's end itself
                for p in some:
                    parts[p] = np.array(self.bare.encode(p, add_special_tokens=False).ids, self.kind).tobytes()
                continue
            raw, at = ids.tobytes(), 0
            for p, to in zip(some, cuts):
                parts[p] = raw[at:to]
                at = to
        for w in plain:
            ps = cut(w)
            words[w] = parts[ps[0]] if len(ps) == 1 else b"".join([parts[p] for p in ps])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.frombuffer(x, self.kind) for x in self.encode_raw(texts)]

    def encode_raw(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as bytes of ``kind``."""
        collecting = gc.isenabled()
        gc.disable()  # the tables hold no cycles, and walking them for each batch takes longer than the work
        try:
            return self._raw(texts)
        finally:
            if collecting:
                gc.enable()

    def _raw(self, texts: list[str]) -> list[bytes]:
        """A word is looked up once, and again only where a text has new ones."""
        cut = [t.replace("\n", " ").split(" ") for t in texts]
        seen = self.words
        found = [list(map(seen.get, ws)) for ws in cut]
        late = [k for k, ids in enumerate(found) if None in ids]
        if not late:
            return list(map(b"".join, found))
        new = list({w for k in late for w, ids in zip(cut[k], found[k]) if ids is None})
        room = self.entries // 2
        if len(new) > room:  # one text after the other, each by blocks of words
            return [self._long(ws, room) for ws in cut]
        self._learn(new)  # where the table started anew, the words that were found are in ``found``
        get = self.words.__getitem__
        fresh = self.words is not seen
        for k in late:
            found[k] = list(map(get, cut[k])) if not fresh else [get(w) if x is None else x for w, x in zip(cut[k], found[k])]
        return list(map(b"".join, found))

    def _long(self, words: list[str], room: int) -> bytes:
        out = []
        for k in range(0, len(words), room):
            some = words[k:k + room]
            missing = list({w for w in some if w not in self.words})
            if missing:
                seen = self.words
                self._learn(missing)
                if self.words is not seen:
                    self._learn(list({w for w in some if w not in self.words}))
            out.append(b"".join(map(self.words.__getitem__, some)))
        return b"".join(out)


_TOKENIZERS: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    """One tokenizer and word table for a Python worker, kept between tasks."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path, added=True)
    return _TOKENIZERS[path]


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers
    return str(public_tokenizers.path(name))


def _blocks(batches: Iterator[pa.RecordBatch], limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of about ``limit`` bytes of text; a longer text is a slice of its own."""
    for b in batches:
        start, size = 0, 0
        lengths = pa.compute.binary_length(b.column("text")).to_pylist()
        for i, n in enumerate(lengths):
            if size and size + n > limit:
                yield b.slice(start, i - start)
                start, size = i, 0
            size += n
        if start < len(lengths):
            yield b.slice(start)


def _tokenize(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute  # noqa: F401
        tok = tokenizer(path)
        part, before = TaskContext.get().partitionId(), 0
        wide = tok.kind.itemsize
        small = end_id <= np.iinfo(tok.kind).max
        end = np.array([end_id if small else 0], tok.kind).tobytes()
        for b in _blocks(batches):
            raw = tok.encode_raw(b.column("text").to_pylist())
            n = np.fromiter(map(len, raw), np.int64, len(raw)) // wide + 1
            ends = np.cumsum(n)
            first = before + ends - n
            before += int(n.sum())
            ids = np.frombuffer(end.join([*raw, b""]), tok.kind).astype("<u4")  # the block's ids, an end behind each text
            if not small:
                ids[ends - 1] = end_id
            places = np.concatenate([[0], ends * 4])
            if places[-1] < 1 << 31:
                column = pa.Array.from_buffers(pa.binary(), len(raw), [None, pa.py_buffer(places.astype(np.int32)), pa.py_buffer(ids)])
            else:  # of one very long text
                column = pa.array([ids[e - k:e].tobytes() for e, k in zip(ends.tolist(), n.tolist())], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(np.full(len(n), part, np.int64)), pa.array(first), pa.array(n),
                 column],
                names=["doc_id", "part", "before", "doc_tokens", "ids"])
        pa.default_memory_pool().release_unused()  # an idle worker keeps its tables, not the room of its batches
    return run


def tokenized(docs: DataFrame, path: str | None = None, end_id: int = END_ID, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """Pass one, written: doc_id, part, before (ids before it in its partition), doc_tokens, ids (little-endian u32)."""
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return stage(rows.mapInArrow(_tokenize(path or vocabulary_path(), end_id),
                                 f"doc_id {kind}, part long, before long, doc_tokens long, ids binary"), "pack-tokens")


def pieces(tokens: DataFrame, size: int = SIZE) -> DataFrame:
    """Pass two: where every document lies in the windows.

    doc_id, start, length, ids (the piece's own, little-endian u32), doc_tokens, sequence_id, offset. A piece
    ends where its window or its document ends; ``is_boundary`` marks pieces of a document that was cut.
    """
    totals = tokens.groupBy("part").agg(F.sum("doc_tokens").alias("total"))
    place = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("total").over(place), F.lit(0).cast("long")).alias("base"))
    # one row of two numbers for each task of pass one, so its size follows the number of tasks, not of rows
    at = tokens.join(F.broadcast(bases), "part").withColumn("_first", F.col("base") + F.col("before"))
    n = F.lit(size).cast("long")
    windows = F.sequence(F.floor(F.col("_first") / n).cast("long"),
                         F.floor((F.col("_first") + F.col("doc_tokens") - 1) / n).cast("long"))

    def piece(w):
        begin = F.greatest(w * n, F.col("_first"))
        end = F.least((w + 1) * n, F.col("_first") + F.col("doc_tokens"))
        start = begin - F.col("_first")
        return F.struct(start.alias("start"), (end - begin).alias("length"), w.alias("sequence_id"),
                        (begin - w * n).alias("offset"),
                        F.substring(F.col("ids"), (start * 4 + 1).cast("int"), ((end - begin) * 4).cast("int")).alias("ids"))

    cut = at.select("doc_id", "doc_tokens", F.inline(F.transform(windows, piece)))
    return cut.withColumn("is_boundary", F.col("length") < F.col("doc_tokens"))


def pack(docs: DataFrame, size: int = SIZE, path: str | None = None, end_id: int = END_ID, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """All documents, concatenated and cut: the pieces of ``pieces``.

    A null text is empty, and an empty text is its end id alone, so every row has at least one piece. Rows that
    repeat an id are documents of their own. Order is that of the input's partitions; an empty table gives no
    pieces. Other columns are not read.
    """
    return pieces(tokenized(docs, path, end_id, id_col, text_col), size)


def sequences(cut: DataFrame, size: int = SIZE, pad_id: int = 0) -> DataFrame:
    """Training rows: sequence_id, ids (``size`` long, padded at the end), n_tokens, documents (piece starts)."""
    rows = F.sort_array(F.collect_list(F.struct("offset", "length", "doc_id", "ids")))
    got = cut.groupBy("sequence_id").agg(rows.alias("_rows"), F.sum("length").alias("n_tokens"))
    blank = F.repeat(F.lit(f"{int(pad_id).to_bytes(4, 'little').hex()}"), (F.lit(size) - F.col("n_tokens")).cast("int"))
    joined = F.aggregate("_rows", F.lit(b""), lambda acc, r: F.concat(acc, r["ids"]))
    return got.select("sequence_id", F.concat(joined, F.unhex(blank)).alias("ids"), "n_tokens",
                      F.transform("_rows", lambda r: F.struct(r["doc_id"].alias("doc_id"), r["offset"].alias("offset"),
                                                              r["length"].alias("length"))).alias("documents"))
