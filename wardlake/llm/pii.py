"""Personal data by weak supervision: labelers vote on spans, their reliabilities are estimated, a classifier decides.

Base spans (e-mail, ip, card, phone by fixed patterns) always stay. Further spans are proposed where no base span lies:
by looser patterns (national numbers, spelled-out addresses), by the longest valid beginning of a phone match that
the base pattern ran on into the next number and dropped, by the gazetteer (an address spelled with a known top domain)
and by context (a number after a word such as ``call``). On every span, base or proposed, regex, gazetteer and context labelers vote yes, no or
nothing. The votes of the whole table are counted by pattern (four kinds, three votes for each of five labelers, so
a bounded table whatever the number of spans). Expectation-maximisation estimates from these counts how reliable each labeler is and
how likely each pattern is personal data, without labels. These likelihoods train a logistic span classifier, which adds the
proposed spans it finds likelier than ``LEAST_CHANCE``.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlake.llm.common import text_of

KINDS = ["email", "ip", "card", "phone"]
LEAST_CHANCE = 0.9
LABELERS = ["shape", "check", "gazetteer", "context", "edges"]
ROUNDS = 200

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a number's first digit has no digit before it: a later digit of the same number could begin no other match
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

PROPOSED = [
    ("card", re.compile(r"(?<![0-9A-Za-z])(?:[0-9]{14,19}|[0-9]{4}(?:[ -][0-9]{4}){3})(?![0-9A-Za-z])")),
    ("phone", re.compile(r"(?<![0-9A-Za-z])\+?[0-9]{1,3}[ .-]?\([0-9]{2,4}\)[ .-]?[0-9]{3,4}[ .-]?[0-9]{4}(?![0-9A-Za-z])")),
    ("phone", re.compile(r"(?<![0-9A-Za-z])\([0-9]{3}\) ?[0-9]{3}[.-][0-9]{4}(?![0-9A-Za-z])")),
    ("phone", re.compile(r"(?<![0-9A-Za-z+.-])[0-9]{3}([ .-])[0-9]{3}\1[0-9]{4}(?![0-9A-Za-z]|[.-][0-9])")),
    ("email", re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?(?:\[at\]|\(at\)) ?[A-Za-z0-9-]{1,63}"
                         r"(?: ?(?:\[dot\]|\(dot\)|\.) ?[A-Za-z0-9-]{1,63}){1,5}")),
]
# Shapes, prefixes and words the labelers know.
SHAPES = {"email": re.compile(r"[^@]+@[^@.]+(?:\.[^@.]+)*\.[A-Za-z]{2,}"), "ip": re.compile(r"(?:[0-9]{1,3}\.){3}[0-9]{1,3}"),
          "card": re.compile(r"[0-9]{16}|[0-9]{4}(?:[ -][0-9]{4}){3}|3[47][0-9]{13}"),
          "phone": re.compile(r"\+?[0-9]{0,3}[ .-]?\(?[0-9]{2,4}\)?[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}|[0-9]{3}[ .-]?[0-9]{4}")}
CARD_PREFIX = re.compile(r"4|5[1-5]|2[2-7]|3[0-9]|6")
TOP_DOMAINS = frozenset("com org net edu gov info biz io co uk de fr es it nl eu ch at us ca au jp".split())
CONTEXT = {"email": frozenset("mail email contact write correo courriel kontakt".split()),
           "ip": frozenset("ip address host server client adresse".split()),
           "card": frozenset("card visa mastercard amex credit debit payment karte carte tarjeta".split()),
           "phone": frozenset("call phone tel telephone fax mobile cell ring telefon téléphone teléfono".split())}
AGAINST = frozenset("token key hash sha md5 version id order invoice serial isbn issn doi password secret".split())
_WORD = re.compile(r"\w+")
GROUP = re.compile(r"[0-9]+")
#: A number after a context word, and an address spelled in words that ends in a top domain of the gazetteer.
ANNOUNCED = re.compile(r"(?i:\b(?:" + "|".join(sorted(CONTEXT["phone"])) + r")\b)[^\w\n+(]{1,4}([(]?[0-9][0-9 ().-]{5,18}[0-9])(?![0-9A-Za-z])")
SPELLED = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} at [A-Za-z0-9-]{1,63}(?: dot [A-Za-z0-9-]{1,63}){0,4} dot (?:"
                     + "|".join(sorted(TOP_DOMAINS)) + r")(?![A-Za-z0-9])")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        n = ord(c) - 48
        if k % 2:
            n = 2 * n - 9 * (n > 4)
        total += n
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) in order; kind is the place in KINDS."""
    out = []
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            out.append((start, 0, domain.end()))
            done = domain.end()
        at = text.find("@", max(at + 1, done))
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14:
            d = _digits(m.group())
            if 14 <= len(d) <= 19 and luhn(d):
                out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= len(_digits(m.group())) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def _phone_beginnings(text: str) -> Iterator[tuple[int, int]]:
    """Beginnings, longest first, of the base phone matches that have too many digits, cut where a group of digits ends."""
    if "+" in text:
        for m in PHONE.finditer(text):
            if len(_digits(m.group())) <= 15:
                continue
            n, ends = 0, []
            for g in GROUP.finditer(text, m.start(), m.end()):
                n += g.end() - g.start()
                if n > 15:
                    break
                if n >= 10:
                    ends.append(g.end())
            yield from ((m.start(), e) for e in reversed(ends))


def _after_words(text: str) -> Iterator[tuple[int, int]]:
    """Numbers of 7 to 15 digits right after a word that announces a phone number."""
    for m in ANNOUNCED.finditer(text):
        if 7 <= len(_digits(m.group(1))) <= 15:
            yield m.span(1)


def _apart(got, taken: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Of ``got``, in order, what overlaps neither ``taken`` (merged, sorted) nor an earlier one: one binary search each."""
    starts, ends = [a for a, _ in taken], [b for _, b in taken]
    out: list[tuple[int, int]] = []
    for a, b in got:
        k = bisect.bisect_left(starts, b)
        if (k == 0 or ends[k - 1] <= a) and (not out or out[-1][1] <= a):
            out.append((a, b))
    return out


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a < out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], b)
        else:
            out.append((a, b))
    return out


def proposed_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Looser spans that overlap neither a base span nor each other; earlier proposers first."""
    taken, out = _merged([(a, b) for a, _, b in base]), []
    ways = [("phone", _phone_beginnings(text))]
    ways += [(kind, (m.span() for m in p.finditer(text))) for kind, p in PROPOSED if kind != "email" or "at" in text]
    if " at " in text:
        ways.append(("email", (m.span() for m in SPELLED.finditer(text))))
    ways.append(("phone", _after_words(text)))
    for kind, got in ways:
        new = _apart(got, taken)
        if new:
            out += [(a, KINDS.index(kind), b) for a, b in new]
            taken = _merged(taken + new)
    return sorted(out)


def votes(text: str, span: tuple[int, int, int]) -> str:
    """One character per labeler: y, n or - for no vote."""
    start, k, end = span
    kind, found = KINDS[k], text[span[0]:span[2]]
    digits = _digits(found)
    shape = "y" if SHAPES[kind].fullmatch(found) else "n"
    if kind == "card":
        check = "y" if 14 <= len(digits) <= 19 and luhn(digits) else "n"
        known = "y" if CARD_PREFIX.match(digits) else "n"
    elif kind == "phone":
        check = "y" if 10 <= len(digits) <= 15 else "-" if 7 <= len(digits) <= 9 else "n"  # local numbers are shorter
        known = "y" if found.startswith("+") else "-"
    elif kind == "ip":
        check = "n" if digits.startswith("0") else "y"
        known = "y" if found.startswith(("10.", "127.", "192.168.", "172.16.")) else "-"
    else:
        check = "y" if len(found) <= 254 else "n"
        known = "y" if re.split(r"[.\])]", found)[-1].strip().lower() in TOP_DOMAINS else "n"
    before = [w.lower() for w in _WORD.findall(text[max(0, start - 40):start])][-4:]
    context = "y" if CONTEXT[kind].intersection(before) else "n" if AGAINST.intersection(before) else "-"
    left, right = text[start - 1:start] if start else " ", text[end:end + 1] or " "
    edges = "n" if left in "=\"'#/_" or right in "\"'/_=" or left.isalnum() or right.isalnum() else "y"
    return shape + check + known + context + edges


def estimate(counts: dict[tuple[int, str], float], rounds: int = ROUNDS) -> dict[tuple[int, str], float]:
    """EM over vote patterns: the chance that a span of each (kind, votes) is personal data.

    Per labeler the chances of its three votes given yes and given no, per kind the share of yes; votes are taken as
    independent given the truth. It starts from the belief that a labeler is right four times in five.
    """
    if not counts:
        return {}
    keys = sorted(counts)
    n = np.array([counts[k] for k in keys], float)
    kind = np.array([k for k, _ in keys])
    vote = np.array([["yn-".index(c) for c in v] for _, v in keys])
    start = np.array([[0.7, 0.1, 0.2], [0.1, 0.7, 0.2]])  # given yes, given no
    rates = np.stack([start] * len(LABELERS), axis=1)
    share = np.full(len(KINDS), 0.5)
    chance = np.zeros(len(keys))
    for _ in range(rounds):
        log = np.log(rates[:, np.arange(len(LABELERS)), vote]).sum(axis=2)
        odds = log[0] - log[1] + np.log(share[kind] / (1 - share[kind]))
        chance = 1 / (1 + np.exp(-odds))
        for truth, p in ((0, chance * n), (1, (1 - chance) * n)):
            for lab in range(len(LABELERS)):
                got = np.bincount(vote[:, lab], p, 3) + 10 * start[truth]  # the first belief weighs ten spans
                rates[truth, lab] = got / got.sum()
        for k in range(len(KINDS)):
            mine = kind == k
            share[k] = ((chance * n)[mine].sum() + 1) / (n[mine].sum() + 2)
    return dict(zip(keys, chance.tolist()))


def _features(kind: int, pattern: str) -> np.ndarray:
    x = np.zeros(len(KINDS) + 2 * len(LABELERS) + 1)
    x[kind] = 1
    for k, c in enumerate(pattern):
        if c != "-":
            x[len(KINDS) + 2 * k + (c == "n")] = 1
    x[-1] = 1
    return x


class SpanClassifier:
    """Logistic regression on kind and votes, fitted to the chances of ``estimate`` weighted by their counts."""

    def __init__(self, counts: dict[tuple[int, str], float]):
        self.weights = np.zeros(len(KINDS) + 2 * len(LABELERS) + 1)
        chance = estimate(counts)
        if not chance:
            return
        keys = sorted(chance)
        x = np.stack([_features(*k) for k in keys])
        y = np.array([chance[k] for k in keys])
        n = np.log1p(np.array([counts[k] for k in keys], float))
        for _ in range(50):  # Newton steps with a small ridge
            p = 1 / (1 + np.exp(-x @ self.weights))
            slope = x.T @ (n * (y - p)) - 0.01 * self.weights
            bend = (x * (n * p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(x.shape[1])
            step = np.linalg.solve(bend, slope)
            self.weights += np.clip(step, -2, 2)
            if np.abs(step).max() < 1e-8:
                break

    def chance(self, kind: int, pattern: str) -> float:
        return float(1 / (1 + np.exp(-_features(kind, pattern) @ self.weights)))


def _vote_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[tuple[int, str], int] = {}
    for b in batches:
        for text in b.column("text").to_pylist():
            base = base_spans(text)
            for s in base + proposed_spans(text, base):
                key = s[1], votes(text, s)
                counts[key] = counts.get(key, 0) + 1
    yield pa.RecordBatch.from_arrays(
        [pa.array([k for k, _ in counts], pa.int64()), pa.array([v for _, v in counts], pa.string()),
         pa.array(list(counts.values()), pa.int64())], names=["kind", "votes", "n"])


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def _found(model: SpanClassifier):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            base_col, all_col = [], []
            for text in b.column("text").to_pylist():
                base = base_spans(text)
                more = [s for s in proposed_spans(text, base) if model.chance(s[1], votes(text, s)) >= LEAST_CHANCE]
                base_col.append(base)
                all_col.append(sorted(base + more))
            kind = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int64()), ("end", pa.int64())]))
            as_rows = lambda col: pa.array([[{"start": a, "kind": k, "end": e} for a, k, e in x] for x in col], kind)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), as_rows(base_col), as_rows(all_col),
                 pa.array([hashlib.sha256(written(x).encode()).hexdigest() for x in base_col]),
                 pa.array([written(x) for x in all_col])],
                names=["doc_id", "base", "found", "base_sha256", "spans"])
    return run


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, base and found (arrays of start, kind, end in code points; kind is the place in
    KINDS), base_sha256, spans (kind:start:end by start, then kind).

    A null or empty text has no spans. Rows that repeat are read on their own; an empty table gives no rows; other
    columns are not read. Without any span the classifier has nothing to learn from and adds nothing.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    # at most 4 * 3^5 rows reach the driver
    counted = rows.select("text").mapInArrow(_vote_counts, "kind long, votes string, n long").groupBy("kind", "votes").agg(
        F.sum("n").alias("n")).collect()
    model = SpanClassifier({(r["kind"], r["votes"]): r["n"] for r in counted})
    span = "array<struct<start:long,kind:long,end:long>>"
    return rows.mapInArrow(_found(model), f"doc_id {kind}, base {span}, found {span}, base_sha256 string, spans string")
