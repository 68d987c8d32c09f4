"""Personal data by weak supervision.

Base spans (e-mail, IP, card, phone) follow fixed patterns and always stay.  Further candidates come from
wider patterns: numbers and addresses in other spellings, and secrets.  Five labelers vote on every
candidate and base span: format, checksum, gazetteer, words before it, and shape.  Votes and shape features
are counted over all documents; expectation-maximisation estimates the labelers' reliabilities from the
counts, for each kind by itself, and a logistic regression on the resulting soft labels is the final classifier, which decides about
the further candidates.

The text is read once.  What is kept of it is a row of spans per document; what reaches the driver is one
count for each distinct pattern of votes and features, at most ``5 * 3**5 * 2**4`` of them.

Defined results: a null text is empty and has no spans.  Positions count code points.  Rows with null or
repeated doc_ids are judged like any other.  Other columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, whole_text, written

KINDS = ("email", "ip", "card", "phone", "secret")
BASE = 4
LABELERS = 5
FEATURES = 4
THRESHOLD = 0.5
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits is entered at its start only and never given back: the same matches, in linear time.
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
LOCAL_PHONE = re.compile(r"(?<![0-9A-Za-z+.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z])")
SECRET = re.compile(r"(?<![A-Za-z0-9_-])(?=[A-Za-z_-]*[0-9])(?=[0-9_-]*[A-Za-z])[A-Za-z0-9_-]{20,}+")
# Lengths that standards allow: 64 characters before the sign, 63 in a part of the domain.
SPELLED = re.compile(r"[A-Za-z0-9._%+-]{1,64} ?[\[(]at[\])] ?[A-Za-z0-9-]{1,63}(?: ?(?:\.|[\[(]dot[\])]) ?[A-Za-z0-9-]{1,63}){1,8}")
#: Gazetteers: endings of addresses, first digits of card numbers, beginnings of well-known keys.
ENDINGS = frozenset("com net org edu gov info io co uk de fr es it nl eu us ca au jp cn ru br in ch at be se".split())
CARD_FIRST = ("4", "51", "52", "53", "54", "55", "34", "37", "6")
KEY_FIRST = ("AKIA", "ghp_", "sk_", "pk_", "xox", "eyJ", "AIza")
#: Words that announce a kind, and words that announce something else.
ANNOUNCE = {
    "email": ("mail", "contact", "write to"),
    "ip": ("ip", "address", "host", "server"),
    "card": ("card", "visa", "credit", "payment"),
    "phone": ("phone", "tel", "call", "mobile", "fax"),
    "secret": ("key", "token", "secret", "password", "passwd", "pwd", "api"),
}
DENY = ("version", "isbn", "issn", "order", "figure", "chapter", "page", "http", "www")


def _luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c)
        if k % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """Each @ has one possible start, the run of local characters before it."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        s = at
        while s > end and text[s - 1] in LOCAL:
            s -= 1
        m = DOMAIN.match(text, at + 1) if s < at else None
        if m:
            end = m.end()
            out.append((s, end))
        at = text.find("@", max(at + 1, end))
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, sorted."""
    out = [(s, 0, e) for s, e in _emails(text)]
    if DIGIT.search(text):
        for m in IP.finditer(text):
            if all(int(p[-4:]) <= 255 and len(p.lstrip("0")) <= 3 for p in m[0].split(".")):
                out.append((m.start(), 1, m.end()))
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = m[0].replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and _luhn(digits):
                    out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 10 <= len(DIGIT.findall(m[0])) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Further spans that do not overlap base spans or each other; earlier patterns come first."""
    found: list[tuple[int, int, int]] = []
    if "at]" in text or "at)" in text:
        found += [(m.start(), 0, m.end()) for m in SPELLED.finditer(text)]
    if DIGIT.search(text):
        found += [(m.start(), 4, m.end()) for m in SECRET.finditer(text)]
        found += [(m.start(), 3, m.end()) for m in LOCAL_PHONE.finditer(text)]
        for m in CARD.finditer(text):
            if 13 <= len(m[0]) <= 40 and 13 <= len(DIGIT.findall(m[0])) <= 19:
                found.append((m.start(), 2, m.end()))
    taken = sorted((s, e) for s, _, e in base)
    out: list[tuple[int, int, int]] = []
    from bisect import bisect_left, insort

    for s, kind, e in found:
        k = bisect_left(taken, (s, e))
        if (k and taken[k - 1][1] > s) or (k < len(taken) and taken[k][0] < e):
            continue
        insort(taken, (s, e))
        out.append((s, kind, e))
    return sorted(out)


def votes(text: str, s: int, kind: int, e: int, is_base: bool) -> int:
    """The pattern of a span: five votes in base 3 and four feature bits, with its kind."""
    span, name = text[s:e], KINDS[kind]
    digits = "".join(DIGIT.findall(span))
    before = text[max(0, s - 40) : s].lower()
    form = 1 if is_base else 0
    check = 0
    if kind == 2:
        check = 1 if _luhn(digits) else -1
    elif kind == 4:
        check = 1 if len(set(span)) >= 10 else -1
    known = 0
    if kind == 0:
        known = 1 if re.split(r"[^A-Za-z]+", span.lower().rstrip("-."))[-1] in ENDINGS else -1
    elif kind == 2:
        known = 1 if digits.startswith(CARD_FIRST) else -1
    elif kind == 1:
        known = -1 if digits[:1] == "0" else 0
    elif kind == 4:
        known = 1 if span.startswith(KEY_FIRST) else 0
    context = 1 if any(w in before for w in ANNOUNCE[name]) else -1 if any(w in before for w in DENY) else 0
    shape = -1 if kind in (2, 3) and len(set(digits)) <= 2 else 1 if kind == 4 and re.fullmatch(r"[0-9a-f]{32,}|[0-9A-F]{32,}", span) else 0
    ballot = 0
    for v in (form, check, known, context, shape):
        ballot = ballot * 3 + v + 1
    bits = (s > 0 and text[s - 1].isalnum()) | (e < len(text) and text[e].isalnum()) << 1 | (len(span) >= 24) << 2 | (len(set(span)) * 2 >= len(span)) << 3
    return (kind * 3**LABELERS + ballot) << FEATURES | bits


def _unpack(patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(kind, votes -1..1 by labeler, feature bits) of patterns."""
    bits = patterns[:, None] >> np.arange(FEATURES) & 1
    rest = patterns >> FEATURES
    ballot = rest % 3**LABELERS
    return rest // 3**LABELERS, ballot[:, None] // 3 ** np.arange(LABELERS - 1, -1, -1) % 3 - 1, bits


def estimate(patterns: np.ndarray, n: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """(probability of each pattern to be personal data, reliability of each labeler by kind), by EM."""
    kind, vote, _ = _unpack(patterns)
    right, prior = np.full((len(KINDS), LABELERS), 0.8), np.full(len(KINDS), 0.5)
    p = np.full(len(patterns), 0.5)
    of_kind = (kind[:, None] == np.arange(len(KINDS))).T.astype(float)
    for _ in range(rounds):
        logit = np.log(prior[kind] / (1 - prior[kind])) + (vote * np.log(right / (1 - right))[kind]).sum(1)
        p = 1 / (1 + np.exp(-logit))
        weight = n[:, None] * (vote != 0)
        agree = weight * np.where(vote > 0, p[:, None], 1 - p[:, None])
        # As if each labeler had been right in eight of ten votes before.
        right = np.clip((of_kind @ agree + 8) / (of_kind @ weight + 10), 0.55, 0.99)
        prior = np.clip((of_kind @ (p * n) + 5) / (of_kind @ n + 10), 0.05, 0.95)
    return p, right


def _design(patterns: np.ndarray) -> np.ndarray:
    kind, vote, bits = _unpack(patterns)
    return np.concatenate([np.ones((len(patterns), 1)), kind[:, None] == np.arange(len(KINDS)), vote > 0, vote < 0, bits], axis=1).astype(float)


def fit(patterns: np.ndarray, n: np.ndarray, rounds: int = 30, ridge: float = 1.0) -> np.ndarray:
    """Weights of the span classifier: logistic regression on EM's soft labels, by Newton steps."""
    x = _design(patterns)
    w = np.zeros(x.shape[1])
    if not len(patterns):
        return w
    y, _ = estimate(patterns, n)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (n * (p - y)) + ridge * w
        hessian = (x * (n * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def extract(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, starts, ends, patterns, is_base): the base spans and candidates of every row, by start."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text(text).alias("text"))

    def read(batches):
        import pyarrow as pa

        for batch in batches:
            columns: list[list] = [[], [], [], []]
            for t in batch.column(1).to_pylist():
                base = base_spans(t)
                spans = sorted([(s, k, e, True) for s, k, e in base] + [(s, k, e, False) for s, k, e in candidates(t, base)])
                columns[0].append([s for s, _, _, _ in spans])
                columns[1].append([e for _, _, e, _ in spans])
                columns[2].append([votes(t, *x) for x in spans])
                columns[3].append([b for _, _, _, b in spans])
            kinds = [pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.bool_())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, t) for c, t in zip(columns, kinds)]], names=["doc_id", "starts", "ends", "patterns", "is_base"])

    return rows.mapInArrow(read, "doc_id long, starts array<int>, ends array<int>, patterns array<int>, is_base array<boolean>")


def find(docs: DataFrame, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, spans): per row an array of (kind, start, end, is_base), by start and kind."""
    spans = written(extract(docs, text), "pii-spans")
    counted = spans.select(F.explode("patterns").alias("pattern")).groupBy("pattern").count()
    rows = counted.collect()  # at most one count for each possible pattern
    patterns = np.array([r["pattern"] for r in rows], np.int64)
    order = np.argsort(patterns)
    patterns, n = patterns[order], np.array([r["count"] for r in rows], float)[order]
    weights = fit(patterns, n)
    good = set(patterns[1 / (1 + np.exp(-np.clip(_design(patterns) @ weights, -30, 30))) >= threshold].tolist()) if len(patterns) else set()

    def decide(batches):
        import pyarrow as pa

        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("is_base", pa.bool_())]))
        for batch in batches:
            out = []
            for starts, ends, found, is_base in zip(*(c.to_pylist() for c in batch.columns[1:]), strict=True):
                out.append([{"kind": KINDS[(p >> FEATURES) // 3**LABELERS], "start": s, "end": e, "is_base": b} for s, e, p, b in zip(starts, ends, found, is_base, strict=True) if b or p in good])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, kind)], names=["doc_id", "spans"])

    return spans.mapInArrow(decide, "doc_id long, spans array<struct<kind:string,start:int,end:int,is_base:boolean>>")
