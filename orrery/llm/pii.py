"""Personal data: candidate spans scored by boosted trees.

One pass over the texts finds the base spans (fixed patterns and checks) and
lets high-recall generators propose spans, overlapping ones too: digit groups
however separated, numbers without a plus sign, spelled-out or spaced e-mail
addresses. Each proposal has format and context features; none tells a base
check itself (plus sign, Luhn digit, octet range), so trees learn what
personal data looks like, not the base rules. A proposal that covers most of
a base span of its kind, or most of which it covers, is a positive.

A proposal is refuted if its digits cannot be what it is proposed for,
however they are written: a Luhn digit that does not fit, a part above 255,
too few or too many digits. Refuted proposals are negatives and never become
spans. What misses the base format only (no plus sign, a spelled-out address,
other separators) is unlabelled rather than wrong: if c is the share of true
spans that are in the base format, a group of proposals of which a share r is
labelled holds r / c true spans. c is told per kind by the better half of its
positives (less a standard error, at least MIN_CHECKED). One number in ten
passes Luhn's check by chance, so a ninth of the refuted cards is taken off
the labelled ones of their group.

Texts fall into two halves by hash. Each half has its trees, fitted on a
bounded sample of it (SAMPLE rows in all, drawn per kind and label by a hash of
row, text and place; copies count once); they score the other half, so no
proposal is scored by trees that saw its text. Scores of all proposals are
counted in BINS bins per kind and label, and a kind's threshold is the least
bin from which on PRECISION of the proposals are true, one more error than seen
assumed. Proposals above it become spans, the likeliest first, if they touch no
base or chosen span. Base spans always stay.

Defined results: a null text is empty and has no spans; a half without
positives or without other proposals gives the other half no spans; repeated
rows are scanned one by one; long texts are scanned whole in linear time.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.llm.boosting import Trees
from orrery.llm.common import ship, written

#: The kinds in order, and the base patterns.
KINDS = ("email", "ip", "card", "phone")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A failed start inside a run of digits fails at each later digit of the run.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

SAMPLE = 20_000
PRECISION = 0.95
MIN_CHECKED = 0.5
#: Passers by chance for each refuted proposal, by kind.
BY_CHANCE = (0.0, 0.0, 1 / 9, 0.0)
#: Labels of proposals.
OPEN, TRUE, REFUTED = 0, 1, 2
BINS = 256
CONTEXT = 24

_PROPOSALS = (
    ("email", re.compile(r"[\w.%+-]{1,64}[ ]?(?:@|\(at\)|\[at\]|\{at\})[ ]?"
                         r"[\w-]{1,63}(?:[ ]?(?:\.|\(dot\)|\[dot\]|\{dot\})[ ]?[\w-]{1,63})+")),
    ("ip", re.compile(r"(?<![0-9])[0-9]{1,4}(?:[ ]?\.[ ]?[0-9]{1,4}){3,5}(?![0-9])")),
    ("card", re.compile(r"(?<![0-9])[0-9]{3,7}(?:[ ./_-]{0,2}[0-9]{2,7}){1,6}(?![0-9])")),
    ("phone", re.compile(r"(?<![0-9])(?:[0-9]{1,3}[ .-]?)?\(?[0-9]{2,4}\)?[ ./-]{0,2}[0-9]{2,4}"
                         r"(?:[ ./-]{0,2}[0-9]{2,5}){1,3}(?![0-9])")),
)
_AT = re.compile(r"[ ]?(?:@|\(at\)|\[at\]|\{at\})[ ]?")
_DOT = re.compile(r"[ ]?(?:\.|\(dot\)|\[dot\]|\{dot\})[ ]?")
_HINTS = (
    re.compile(r"(?i)mail|contact|write|address"),
    re.compile(r"(?i)\bip\b|host|server|login|addr"),
    re.compile(r"(?i)card|visa|pay|credit|account|iban"),
    re.compile(r"(?i)phone|tel|call|fax|mobile|whatsapp"),
    re.compile(r"(?i)token|key|secret|hash|sha|uuid|version|isbn|\bid\b"),
)


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and int(part) <= 255


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the base rules, by start, then kind."""
    found = []
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            found.append((0, start, end))
        at = text.find("@", max(at + 1, end))
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(map(_octet, m.group().split("."))):
                found.append((1, m.start(), m.end()))
        for m in _CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and _luhn(digits):
                found.append((2, m.start(), m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
                    found.append((3, m.start(), m.end()))
    return sorted(found, key=lambda s: (s[1], s[0]))


def _side(char: str) -> float:
    return 0.0 if not char or char.isspace() else 1.0 if char.isalpha() else \
        2.0 if char.isdigit() else 3.0


def features(text: str, kind: int, start: int, end: int) -> list[float]:
    span = text[start:end]
    if kind == 0:  # however spelled, so that the sign itself tells nothing
        span = _DOT.sub(".", _AT.sub("@", span))
    groups = [len(g) for g in re.findall(r"[0-9]+", span)] or [0]
    before = text[max(0, start - CONTEXT):start].rstrip("+ ")
    after = text[end:end + CONTEXT]
    digits = sum(groups)
    return [
        *(float(kind == k) for k in range(len(KINDS))), float(len(span)), float(digits),
        float(sum(c.isalpha() for c in span)), float(len(groups)), float(max(groups)),
        float(min(groups)), float(groups[0]), float(groups[-1]), float(span.count(" ")),
        float(span.count("-")), float(span.count(".")), float(span.count("(")),
        float(span.count("@")), float(len(set(span) & set("0123456789"))),
        _side(before[-1:]), _side(after[:1]),
        float(sum(c.isdigit() for c in before)), float(sum(c.isdigit() for c in after)),
        *(float(bool(h.search(before))) for h in _HINTS),
    ]


def refuted(kind: int, span: str) -> bool:
    """Whether the digits of ``span`` rule its kind out in any format."""
    digits = re.findall(r"[0-9]+", span)
    if kind == 1:
        return len(digits) != 4 or not all(map(_octet, digits))
    joined = "".join(digits)
    if kind == 2:
        return not (12 <= len(joined) <= 19 and _luhn(joined))
    return kind == 3 and not 9 <= len(joined) <= 15


def proposals(text: str, base: list[tuple[int, int, int]]) -> list[tuple]:
    """(kind, start, end, features, label) of all generators."""
    out = []
    by_kind = [[s for s in base if s[0] == k] for k in range(len(KINDS))]
    ends = [[s[2] for s in own] for own in by_kind]  # ascending: a kind's spans are apart
    digits = _DIGIT.search(text) is not None
    mail = "@" in text or any(x in text for x in ("(at)", "[at]", "{at}"))
    for kind, (_, pattern) in enumerate(_PROPOSALS):
        if not (mail if kind == 0 else digits):
            continue
        for m in pattern.finditer(text):
            start, end = m.span()
            true, i = False, bisect_right(ends[kind], start)
            while i < len(ends[kind]) and by_kind[kind][i][1] < end:
                _, s, e = by_kind[kind][i]
                true |= 2 * (min(end, e) - max(start, s)) >= max(end - start, e - s)
                i += 1
            label = TRUE if true else REFUTED if refuted(kind, m.group()) else OPEN
            out.append((kind, start, end, features(text, kind, start, end), label))
    return out


_SPAN = "struct<kind:int,start:int,end:int>"
_PROPOSAL = "struct<kind:int,start:int,end:int,features:array<float>,label:int>"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))
    proposal = pa.list_(pa.struct([
        ("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()),
        ("features", pa.list_(pa.float32())), ("label", pa.int32())]))
    for batch in batches:
        base, asked = [], []
        for text in batch["text"].to_pylist():
            own = base_spans(text or "")
            base.append([dict(zip(("kind", "start", "end"), s)) for s in own])
            asked.append([dict(zip(("kind", "start", "end", "features", "label"), p))
                          for p in proposals(text or "", own)])
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], batch["text_key"], pa.array(base, span),
             pa.array(asked, proposal)],
            names=["doc_id", "text_key", "base", "asked"])


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, text hash, base spans and proposals of ``docs`` (doc_id, text), written
    to the shared folder (texts are read once)."""
    ship(docs.sparkSession)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return written(docs.select("doc_id", "text", F.xxhash64("text").alias("text_key")).mapInArrow(
        _scan, f"doc_id {id_type}, text_key bigint, base array<{_SPAN}>, asked array<{_PROPOSAL}>"), "spans")


def _sample(scanned: DataFrame, sample: int):
    """About ``sample`` different proposals, as many of each (half, kind,
    label), as a pandas frame."""
    rows = scanned.select("doc_id", "text_key", F.explode("asked").alias("p")).select(
        F.xxhash64("doc_id", "text_key", "p.kind", "p.start", "p.end").alias("key"),
        F.col("text_key").bitwiseAND(1).alias("half"), "p.kind", "p.label", "p.features")
    strata = rows.groupBy("half", "kind", "label").agg(
        F.approx_count_distinct("key").alias("n")).collect()
    each = sample / (6 * len(KINDS))
    drawn = F.lit(False)
    for r in strata:
        # A fixed share of the 64-bit hash range; the bound holds on average.
        limit = int(-(1 << 63) + min(1.0, each / max(1, r.n)) * ((1 << 64) - 1))
        drawn |= (F.col("half") == r.half) & (F.col("kind") == r.kind) \
            & (F.col("label") == r.label) & (F.col("key") <= F.lit(min(limit, (1 << 63) - 1)))
    return rows.filter(drawn).groupBy("key").agg(
        *(F.first(c).alias(c) for c in ("half", "kind", "label", "features"))) \
        .toPandas().sort_values(["key", "kind", "label"], kind="stable")


def _bins(trees: list[Trees | None], x: np.ndarray, half: np.ndarray) -> np.ndarray:
    """Score bins by the other half's trees; -1 without trees."""
    out = np.full(len(x), -1, dtype=np.int64)
    for h in (0, 1):
        own = half == h
        if trees[1 - h] is not None and own.any():
            out[own] = np.clip((trees[1 - h].score(x[own]) + 8) * (BINS / 16), 0, BINS - 1)
    return out


def _proposals_of(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """kind, label, features, half of all proposals of a batch, and their
    number per row."""
    count = pc.list_value_length(batch["asked"]).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = batch["asked"].flatten()
    kind, label = (pc.struct_field(flat, c).to_numpy(zero_copy_only=False).astype(np.int64)
                   for c in ("kind", "label"))
    x = pc.struct_field(flat, "features").flatten().to_numpy(zero_copy_only=False)
    half = batch["text_key"].to_numpy(zero_copy_only=False).astype(np.int64) & 1
    x = x.astype(np.float64).reshape(len(kind), len(x) // max(1, len(kind)))
    return kind, label, x, np.repeat(half, count), count


def _counted(trees):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(len(KINDS) * 3 * BINS, dtype=np.int64)
        for batch in batches:
            kind, label, x, half, _ = _proposals_of(batch)
            cell = _bins(trees.value, x, half)
            on = cell >= 0
            seen += np.bincount(((3 * kind + label) * BINS + cell)[on], minlength=len(seen))
        cells = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(seen[cells])],
                                         names=["cell", "n"])
    return run


def chances(positive: np.ndarray, every: np.ndarray, precision: float) -> np.ndarray:
    """Of one kind, by bin: the chance that a proposal is true, from the
    labelled and all proposals that are not refuted; -1 below the threshold."""
    out = np.full(len(every), -1.0)
    p, n = positive[::-1].cumsum(), every[::-1].cumsum()  # best first
    if not p[-1]:
        return out
    middle = np.searchsorted(p, p[-1] / 2)
    share = p[middle] / n[middle]
    checked = max(MIN_CHECKED, share - np.sqrt(share * (1 - share) / n[middle]))
    pools: list[list] = []  # falling rates, by pooling neighbours
    for own, total in zip(positive[::-1], every[::-1]):
        pools.append([own, total, 1])
        while len(pools) > 1 and pools[-1][0] * pools[-2][1] >= pools[-2][0] * pools[-1][1]:
            last = pools.pop()
            pools[-1] = [x + y for x, y in zip(pools[-1], last)]
    rate = np.concatenate([np.full(bins, own / max(1, total)) for own, total, bins in pools])
    good = np.flatnonzero((every[::-1] > 0) & (p / (n + 1) >= precision * checked)
                          & (rate >= 0.5 * checked))
    if len(good):
        out[len(out) - 1 - good[-1]:] = np.minimum(rate[:good[-1] + 1] / checked, 1)[::-1]
    return out


def fit(scanned: DataFrame, sample: int = SAMPLE, precision: float = PRECISION
        ) -> tuple[list[Trees | None], np.ndarray]:
    """Trees of both halves, and the chances by kind and bin over all
    proposals."""
    data = _sample(scanned, sample)
    trees: list[Trees | None] = []
    for h in (0, 1):
        own = data[data["half"] == h]
        y = (own["label"] == TRUE).to_numpy(np.float64)
        trees.append(Trees().fit(np.array(own["features"].tolist(), dtype=np.float64), y)
                     if 0 < y.sum() < len(y) else None)
    sent = scanned.sparkSession.sparkContext.broadcast(trees)
    seen = np.zeros(len(KINDS) * 3 * BINS, dtype=np.int64)
    for r in scanned.select("text_key", "asked").mapInArrow(
            _counted(sent), "cell bigint, n bigint").groupBy("cell").agg(
            F.sum("n").alias("n")).collect():
        seen[r.cell] = r.n
    seen = seen.reshape(len(KINDS), 3, BINS)
    return trees, np.stack([chances(
        np.maximum(own[TRUE] - luck * own[REFUTED], 0), own[OPEN] + own[TRUE], precision)
        for own, luck in zip(seen, BY_CHANCE)])


def _text_of(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(spans, key=lambda s: (s[1], s[0],
                                                                                     s[2])))


def select_spans(base: list[dict], asked: list[dict], chance: np.ndarray
                 ) -> list[tuple[int, int, int]]:
    """Base spans and the accepted proposals (of a chance not below 0), best
    first, that touch none."""
    taken = [(s["kind"], s["start"], s["end"]) for s in base]
    starts, ends = [], []  # of disjoint stretches in use
    for _, s, e in sorted(taken, key=lambda x: x[1]):
        if ends and s < ends[-1]:
            ends[-1] = max(ends[-1], e)
        else:
            starts.append(s)
            ends.append(e)
    order = sorted(range(len(asked)), key=lambda i: (-chance[i], asked[i]["start"],
                                                     asked[i]["kind"]))
    for i in order:
        a = asked[i]
        at = bisect_right(ends, a["start"])
        if chance[i] >= 0 and (at == len(starts) or starts[at] >= a["end"]):
            taken.append((a["kind"], a["start"], a["end"]))
            starts.insert(at, a["start"])
            ends.insert(at, a["end"])
    return taken


def _choose(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees, table = model.value
        table = np.column_stack([table, np.full(len(KINDS), -1.0)])  # bin -1: no trees
        for batch in batches:
            base, asked = batch["base"].to_pylist(), batch["asked"].to_pylist()
            kind, label, x, half, count = _proposals_of(batch)
            cut = np.concatenate([[0], np.cumsum(count)])
            chance = np.where(label == REFUTED, -1.0, table[kind, _bins(trees, x, half)])
            counts = np.zeros((len(KINDS), len(base)), dtype=np.int64)
            sha, spans = [], []
            for i, (b, a) in enumerate(zip(base, asked)):
                for s in b:
                    counts[s["kind"], i] += 1
                own = [(s["kind"], s["start"], s["end"]) for s in b]
                sha.append(hashlib.sha256(_text_of(own).encode()).hexdigest())
                spans.append(_text_of(select_spans(b, a, chance[cut[i]:cut[i + 1]])))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], *(pa.array(c) for c in counts), pa.array(sha, pa.string()),
                 pa.array(spans, pa.string())],
                names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])
    return run


def find(docs: DataFrame, **params) -> DataFrame:
    """doc_id, base counts per kind, the base spans' digest and all spans as
    ``kind:start:end`` (code points), of ``docs`` (doc_id, text)."""
    scanned = scan(docs)
    model = docs.sparkSession.sparkContext.broadcast(fit(scanned, **params))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return scanned.mapInArrow(_choose(model), ", ".join(
        [f"doc_id {id_type}", *(f"n_{k} bigint" for k in KINDS), "base_sha256 string",
         "spans string"]))


def redact(text: str, spans: str, mark: str = "[{}]") -> str:
    """``text`` with each span replaced by its kind; of overlapping spans the
    first."""
    out, at = [], 0
    for span in filter(None, spans.split(",")):
        kind, start, end = span.split(":")
        if int(start) >= at:
            out += [text[at:int(start)], mark.format(kind.upper())]
            at = int(end)
    return "".join([*out, text[at:]])
