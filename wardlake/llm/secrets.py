"""Secret scan with the ownership of every candidate counted over the whole corpus.

Patterns propose candidates in each text. The value of a candidate is hashed, and all its places are counted by
distinct owner (the source) and distinct repository (a text of an owner, so that copies of one text are one). A value
that ``WIDE_OWNERS`` or more owners hold is an example that people copy; one that only a few hold and that looks drawn
at random is taken for live. Candidates of the base patterns are always reported, those of the other patterns
only where the value looks live.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlake.llm.common import salted_lookup, stage, text_of

BASE = ["assign", "access", "hex"]
ADDED = ["bearer", "jwt", "url", "block", "opaque"]
KINDS = BASE + ADDED
WIDE_OWNERS = 3
LEAST_BITS = 2.5  # mean information of a character of a random value
LEAST_VALUE = 8

# The words of the assignment pattern, and words that mark a placeholder.
NAMES = ["password", "passwd", "secret", "token", "api_?key"]
PLACEHOLDERS = ["changeme", "dummy", "example", "placeholder", "replace", "sample", "test", "xxxx", "your"]


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_VALUE = r"[A-Za-z0-9+/_.=-]"
PATTERNS = {
    "assign": re.compile("(?:" + "|".join(map(_either_case, NAMES)) + r")[\"']?\x20*[:=]\x20*[\"']?(" + _VALUE + "+)"),
    "access": re.compile(r"(AKIA[A-Z0-9]+)"),
    "hex": re.compile(r"(?<![0-9a-f])([0-9a-f]{32,})"),
    "bearer": re.compile(r"[Bb]earer\x20{1,4}(" + _VALUE + "{16,})"),
    "jwt": re.compile(r"(?<![A-Za-z0-9_.-])(eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,})"),
    "url": re.compile(r"://[^\s/:@]{1,64}:([^\s/:@]{4,128})@"),
    "block": re.compile(r"(-----BEGIN\x20[A-Z\x20]{0,40}PRIVATE\x20KEY-----[A-Za-z0-9+/=\s]*)"),
    "opaque": re.compile(r"(?<![A-Za-z0-9+/_-])([A-Za-z0-9+/_-]{24,})"),
}
#: What a text must hold for a pattern to be worth a search.
MARKS = {"bearer": "earer ", "jwt": "eyJ", "url": "://", "block": "PRIVATE KEY", "access": "AKIA"}
LEAST = {"assign": 8, "access": 16, "hex": 32}


def looks_random(value: str) -> bool:
    """A value that may have been drawn at random: long enough, rich enough, no placeholder."""
    if len(value) < LEAST_VALUE:
        return False
    low = value.lower()
    if any(w in low for w in PLACEHOLDERS):
        return False
    counts: dict[str, int] = {}
    for c in value:
        counts[c] = counts.get(c, 0) + 1
    n = len(value)
    return -sum(k / n * math.log2(k / n) for k in counts.values()) >= LEAST_BITS


def _mixed(value: str) -> bool:
    return any(map(str.isdigit, value)) and any(map(str.islower, value)) and any(map(str.isupper, value))


def candidates(text: str) -> list[tuple[int, int, int, str]]:
    """(start, end, kind number, value) in reading order. Base matches too short for their kind are dropped without
    another try; a match of a further pattern must not touch what was found before it."""
    found, taken = [], []
    for k, kind in enumerate(KINDS):
        if kind in MARKS and MARKS[kind] not in text:
            continue
        got = []
        for m in PATTERNS[kind].finditer(text):
            value = m.group(1)
            if kind in LEAST and len(value) < LEAST[kind] or kind == "opaque" and not _mixed(value):
                continue
            got.append((m.start(), m.end(), k, value))
        if kind in ADDED:
            got = _apart(got, sorted(taken))
        taken += [(s, e) for s, e, _, _ in got]
        found += got
    return sorted(found, key=lambda f: (f[0], f[2]))


def _apart(got: list[tuple], taken: list[tuple[int, int]]) -> list[tuple]:
    """What overlaps none of ``taken``; both are sorted by start, so one walk is enough."""
    out, at, reach = [], 0, 0
    for g in got:
        while at < len(taken) and taken[at][0] < g[1]:
            reach = max(reach, taken[at][1])
            at += 1
        if reach <= g[0]:
            out.append(g)
    return out


def _spans(found: list[tuple]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, e, k, _ in found)


def _scan(kind: pa.DataType):
    names = ["doc_id", "owner", *[f"n_{k}" for k in BASE], "base_sha256", "repository", "found"]
    item = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.int32()), ("hash", pa.string()),
                      ("random", pa.bool_())])
    types = [kind, pa.string(), *[pa.int64()] * 3, pa.string(), pa.string(), pa.list_(item)]
    none = hashlib.sha256(b"").hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list] = [[] for _ in names]
            for doc_id, owner, text in zip(*(b.column(c).to_pylist() for c in ("doc_id", "owner", "text"))):
                got = candidates(text)
                base = [f for f in got if f[2] < len(BASE)]
                row = [doc_id, owner, *[sum(f[2] == k for f in base) for k in range(len(BASE))],
                       hashlib.sha256(_spans(base).encode()).hexdigest() if base else none,
                       hashlib.sha256(text.encode()).hexdigest()[:32] if got else None,
                       [{"start": s, "end": e, "kind": k, "hash": hashlib.sha256(v.encode()).hexdigest()[:32],
                         "random": looks_random(v)} for s, e, k, v in got]]
                for c, v in zip(out, row):
                    c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names=names)
    return run


def ownership(places: DataFrame) -> DataFrame:
    """Places (hash, owner, repository) to one row per hash: owners, repositories, places.

    First each (hash, owner, repository) becomes one row, combined in the tasks, then owners and repositories are
    counted, so that a value in a third of all rows is never one task's list.
    """
    once = places.groupBy("hash", "owner", "repository").agg(F.count("*").alias("n"))
    by_owner = once.groupBy("hash", "owner").agg(F.count("*").alias("repositories"), F.sum("n").alias("n"))
    return by_owner.groupBy("hash").agg(F.count("*").alias("owners"), F.sum("repositories").alias("repositories"),
                                        F.sum("n").alias("places"))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
         wide: int = WIDE_OWNERS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_assign, n_access, n_hex, base_sha256, findings.

    findings: array, by place, of (start, end, kind, base, owners, repositories, live); starts and ends are code points,
    the end exclusive. Base candidates are all there, others only where live. A null text is empty, rows without an
    owner share one owner, rows that repeat are rows of their own (and one repository); an empty table gives no rows;
    other columns are not read.
    """
    from pyspark.sql.pandas.types import to_arrow_type
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(owner_col).cast("string").alias("owner"), text_of(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType
    item = "struct<start:bigint,end:bigint,kind:int,hash:string,random:boolean>"
    scanned = stage(rows.mapInArrow(_scan(to_arrow_type(kind)), (
        f"doc_id {kind.simpleString()}, owner string, n_assign long, n_access long, n_hex long, base_sha256 string, "
        f"repository string, found array<{item}>")).withColumn("row", F.monotonically_increasing_id()), "secret-candidates")
    told = scanned.filter("size(found) > 0")
    each = told.select("row", "owner", "repository", F.explode("found").alias("f")).select("*", "f.hash")
    known = stage(ownership(each), "secret-owners")
    names = F.element_at(F.array(*map(F.lit, KINDS)), F.col("f.kind") + 1)
    live = F.col("f.random") & (F.col("owners") < wide)
    judged = salted_lookup(each.select("row", "hash", "f"), known, ["hash"], "inner").select("row", F.struct(
        F.col("f.start").alias("start"), F.col("f.kind").alias("nr"), F.col("f.end").alias("end"), names.alias("kind"),
        (F.col("f.kind") < len(BASE)).alias("base"), "owners", "repositories", live.alias("live")).alias("f"))
    # one document's candidates, as many as its text holds
    lists = judged.filter("f.base OR f.live").groupBy("row").agg(F.sort_array(F.collect_list("f")).alias("findings"))
    fields = ("start", "end", "kind", "base", "owners", "repositories", "live")
    slim = F.transform(F.coalesce("findings", F.array().cast(lists.schema["findings"].dataType)),
                       lambda x: F.struct(*[x[c].alias(c) for c in fields]))
    columns = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", slim.alias("findings")]
    plain = scanned.filter("size(found) = 0").withColumn("findings", F.lit(None).cast(lists.schema["findings"].dataType))
    return told.join(lists, "row", "left").select(columns).unionByName(plain.select(columns))
