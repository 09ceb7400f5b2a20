"""Personal data: fixed patterns, and spans that a weakly supervised model adds.

1. One pass over the texts finds the *base* spans (patterns with checks) and
   *candidates* (looser patterns, the base spans among them). Labelers vote for,
   against or abstain on every candidate: the strict shape, a gazetteer of words
   that announce such data, the characters around it, and what speaks against it.
2. Votes are counted by pattern (kind and one of 3 values per labeler, so a few
   hundred rows at most, however many candidates). Expectation-maximisation over
   the counts estimates how reliable each labeler is, without any labels.
3. A logistic classifier of span features is fitted to the estimated labels of a
   bounded sample (``SAMPLE`` candidates by hash order) and judges all candidates.
   Those above ``KEEP`` that touch no base span are added.

The text is read once; later steps read the staged spans.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docindex.llm.common import Batches, first_by_hash, staged, text_key

EMAIL, IP, CARD, PHONE, SECRET = range(5)
KINDS = ("email", "ip", "card", "phone", "secret")
BASE_KINDS = KINDS[:4]

SAMPLE = 20_000
KEEP = 0.9
EM_ROUNDS = 60
FIT_ROUNDS = 300

# The base patterns.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DIGIT = re.compile(r"[0-9]")

# Looser patterns of candidates.
_LOOSE_PHONE = re.compile(r"(?<![\w.+/-])\(?[0-9]{2,4}\)?(?:[ .-]\(?[0-9]{2,4}\)?){2,4}(?![\w-])")
_LOOSE_CARD = re.compile(r"(?<![\w-])(?:[0-9]{4}[ -]?){3}[0-9]{1,7}(?![\w-])")
_LOOSE_SECRET = re.compile(
    r"(?<!\w)(?:(?=[a-f]*[0-9])[0-9a-f]{32,128}|(?=[A-F]*[0-9])[0-9A-F]{32,128})(?!\w)"
)
_AT = re.compile(r"[\[({]\s?at\s?[\])}]", re.IGNORECASE)
_BEFORE_AT = re.compile(r"[\w.+-]{1,64}\s?\Z")
_AFTER_AT = re.compile(r"\s?[\w-]{1,63}(?:\s?(?:[\[({]\s?dot\s?[\])}]|\.)\s?[\w-]{1,63}){1,4}", re.IGNORECASE)

_STRICT = {
    EMAIL: re.compile(r"[\w.+-]+\s?[\[({@].*", re.S),
    IP: re.compile(r"(?:[0-9]{1,3}\.){3}[0-9]{1,3}"),
    CARD: re.compile(r"[3-6][0-9]{3}(?:[ -]?[0-9]{4}){2}[ -]?[0-9]{1,7}"),
    PHONE: re.compile(r"(?:\+?[0-9]{1,3}[ .-])?\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}"),
    SECRET: re.compile("|".join(f"[0-9{hexa}]{{{n}}}" for hexa in ("a-f", "A-F") for n in (32, 40, 64))),
}
# Words that announce personal data, by kind.
_ANNOUNCES = {
    EMAIL: re.compile(r"\b(?:e-?mail|mail|contact|write|kontakt|correo|courriel)\b", re.I),
    IP: re.compile(r"\b(?:ip|host|server|address|addr|adresse|client)\b", re.I),
    CARD: re.compile(r"\b(?:card|visa|credit|debit|karte|tarjeta|carte|account|konto)\b", re.I),
    PHONE: re.compile(r"\b(?:phone|tel|call|mobile|cell|fax|telefon|mobil|tél|teléfono)\b", re.I),
    SECRET: re.compile(r"\b(?:token|key|secret|password|passwd|api|auth|credential)\b", re.I),
}
_AGAINST = re.compile(r"(?:[$€£#§]|\bv|\bno\.?|\bpage|\bisbn|\bid)\s?\Z", re.I)
_DATE = re.compile(r"(?:19|20)[0-9]{2}[ .-][01]?[0-9][ .-][0-3]?[0-9]")
CONTEXT = 40
HASHED = 32
FEATURES = 20 + HASHED
LABELERS = 4


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of the address pattern, found from their @ in linear time."""
    found, end = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at and start >= end else None
        if domain:
            end = domain.end()
            found.append((start, end))
            at = text.find("@", end)
        else:
            at = text.find("@", at + 1)
    return found


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(kind, start, end)`` in code points, by kind and start."""
    spans = [(EMAIL, *s) for s in emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return spans
    for m in _IP.finditer(text):
        if all(int(p[-4:]) <= 255 and not p[:-4].strip("0") for p in m[0].split(".")):
            spans.append((IP, *m.span()))
    for m in _CARD.finditer(text):
        digits = _digits(m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            spans.append((CARD, *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_digits(m[0])) <= 15:
                spans.append((PHONE, *m.span()))
    return spans


def loose_spans(text: str) -> list[tuple[int, int, int]]:
    spans = []
    for m in _AT.finditer(text):
        before = _BEFORE_AT.search(text, max(0, m.start() - 66), m.start())
        after = _AFTER_AT.match(text, m.end())
        if before and after:
            spans.append((EMAIL, before.start(), after.end()))
    if _DIGIT.search(text):
        for m in _LOOSE_PHONE.finditer(text):
            if 8 <= len(_digits(m[0])) <= 15:
                spans.append((PHONE, *m.span()))
        spans += [(CARD, *m.span()) for m in _LOOSE_CARD.finditer(text)]
        spans += [(SECRET, *m.span()) for m in _LOOSE_SECRET.finditer(text)]
    return spans


def votes_of(text: str, kind: int, start: int, end: int) -> list[int]:
    """What each labeler says: 1 for, -1 against, 0 nothing."""
    span, before = text[start:end], text[max(0, start - CONTEXT) : start]
    after = text[end : end + 1]
    shape = 1 if _STRICT[kind].fullmatch(span) else -1
    announced = 1 if _ANNOUNCES[kind].search(before) else 0
    enclosed = 1 if before[-1:] in ("", " ", "\n", '"', "'", ":", "=", "(") and after in ("", " ", "\n", '"', "'", ".", ",", ")", ";") else -1
    if kind == CARD:
        against = 1 if luhn(_digits(span)) else -1
    else:
        against = -1 if _AGAINST.search(before) or _DATE.search(span) else 0
    return [shape, announced, enclosed, against]


def features_of(text: str, kind: int, start: int, end: int) -> list[float]:
    span, before, after = text[start:end], text[max(0, start - CONTEXT) : start], text[end : end + 1]
    n = len(span)
    digits = sum(c.isdigit() for c in span)
    letters = sum(c.isalpha() for c in span)
    groups = len(re.findall(r"\w+", span))
    own = [0.0] * len(KINDS)
    own[kind] = 1.0
    values = [
        1.0, min(n, 80) / 20, digits / n, letters / n, (n - digits - letters) / n, groups / 5,
        float(luhn(_digits(span))) if digits else 0.0, float("(" in span), float("-" in span), float(" " in span),
        float(before[-1:].isspace()), float(before[-1:] in "\"'=:" and before != ""), float(before[-1:].isalnum()),
        float(after.isspace()), float(after.isalnum()), *own,
    ]
    hashed = [0.0] * HASHED
    for word in re.findall(r"[^\W\d_]+", before.lower())[-3:]:
        hashed[xxhash.xxh32_intdigest(word) % HASHED] = 1.0
    return values + hashed


SPAN = "struct<kind:int,start:int,end:int>"
FOUND = (
    f"doc bigint, text_key bigint, base array<{SPAN}>, "
    "candidates array<struct<kind:int,start:int,end:int,is_base:boolean,votes:array<int>,features:array<float>>>"
)


class Find:
    """Texts to base spans and candidates with votes and features."""

    def __call__(self, batches: Batches) -> Batches:
        for batch in batches:
            bases, candidates = [], []
            for text in batch.column("text"):
                text = text.as_py() or ""
                base = base_spans(text)
                known = set(base)
                rows = []
                for span in sorted(known | set(loose_spans(text))):
                    rows.append(
                        {
                            **dict(zip(("kind", "start", "end"), span)),
                            "is_base": span in known,
                            "votes": votes_of(text, *span),
                            "features": features_of(text, *span),
                        }
                    )
                bases.append([dict(zip(("kind", "start", "end"), s)) for s in base])
                candidates.append(rows)
            span = [("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]
            row = [*span, ("is_base", pa.bool_()), ("votes", pa.list_(pa.int32())), ("features", pa.list_(pa.float32()))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc"),
                    batch.column("text_key"),
                    pa.array(bases, pa.list_(pa.struct(span))),
                    pa.array(candidates, pa.list_(pa.struct(row))),
                ],
                ["doc", "text_key", "base", "candidates"],
            )


def reliabilities(votes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``P(vote | class)`` of each labeler and ``P(true)`` of each vote pattern, by
    expectation-maximisation from the majority vote."""
    truth = np.where(votes.sum(1) > 0, 0.8, 0.3)
    table = np.zeros((votes.shape[1], 3, 2))
    for _ in range(EM_ROUNDS):
        weight = np.stack([(1 - truth) * counts, truth * counts], 1)
        for v in (-1, 0, 1):
            table[:, v + 1] = ((votes == v).T.astype(float) @ weight) + 0.5
        table /= table.sum(1, keepdims=True)
        share = (weight.sum(0) + 1) / (weight.sum() + 2)
        log = np.log(share) + sum(np.log(table[k, votes[:, k] + 1]) for k in range(votes.shape[1]))
        truth = 1 / (1 + np.exp(np.clip(log[:, 0] - log[:, 1], -50, 50)))
    return table, truth


def fit(features: np.ndarray, truth: np.ndarray) -> np.ndarray:
    """Logistic regression on probable labels, by gradient descent with a penalty."""
    w = np.zeros(features.shape[1])
    for _ in range(FIT_ROUNDS):
        p = 1 / (1 + np.exp(-np.clip(features @ w, -30, 30)))
        w -= 0.5 * (features.T @ (p - truth) / len(truth) + 1e-4 * w)
    return w


def span_model(found: DataFrame) -> np.ndarray | None:
    """Weights of the span classifier; None without candidates."""
    spans = found.select("doc", "text_key", F.explode("candidates").alias("c")).select("doc", "text_key", "c.*")
    patterns = spans.groupBy("kind", "votes").agg(F.count(F.lit(1)).alias("n")).collect()
    if not patterns:
        return None
    truth: dict[tuple, float] = {}
    for kind in {p.kind for p in patterns}:
        own = [p for p in patterns if p.kind == kind]
        votes = np.array([p.votes for p in own])
        _, true = reliabilities(votes, np.array([p.n for p in own], float))
        truth |= {(kind, tuple(p.votes)): float(t) for p, t in zip(own, true)}
    n = sum(p.n for p in patterns)
    sample = first_by_hash(spans, n, SAMPLE, "doc", "text_key", "kind", "start", "end")
    sample = sample.select("kind", "votes", "features").collect()
    x = np.array([r.features for r in sample], float)
    return fit(x, np.array([truth[r.kind, tuple(r.votes)] for r in sample]))


def find_personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc, text_key, base, spans)`` per row of ``docs``: arrays of ``(kind,
    start, end)`` with kinds as numbers into ``KINDS`` and code points, end
    exclusive, by kind and start. ``spans`` holds ``base`` and what the model adds.

    A NULL text counts as empty and has no spans; NULL ids stay NULL; repeated
    rows get equal rows. Extra columns are ignored; an empty table gives an empty
    one.
    """
    texts = docs.select(
        F.col(doc_id).cast("bigint").alias("doc"), text_key(F.col(text)).alias("text_key"), F.col(text).alias("text")
    )
    found = staged(texts.mapInArrow(Find(), FOUND), "spans")
    weights = span_model(found)
    if weights is None:
        return found.select("doc", "text_key", "base", F.col("base").alias("spans"))
    w = F.array(*[F.lit(float(x)) for x in weights])
    score = lambda c: F.aggregate(F.zip_with(c["features"], w, lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
    least = float(np.log(KEEP / (1 - KEEP)))
    apart = lambda c: ~F.exists(F.col("base"), lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))
    added = F.filter("candidates", lambda c: ~c["is_base"] & apart(c) & (score(c) >= least))
    added = F.transform(added, lambda c: F.struct(*[c[x].alias(x) for x in ("kind", "start", "end")]))
    return found.select("doc", "text_key", "base", F.sort_array(F.concat("base", added)).alias("spans"))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def number_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("bigint")


class Mask:
    """Replace spans in texts by the names of their kinds."""

    def __call__(self, batches: Batches) -> Batches:
        for batch in batches:
            out = []
            for text, spans in zip(batch.column("text"), batch.column("spans").to_pylist()):
                text, parts, at = text.as_py(), [], 0
                for s in sorted(spans, key=lambda s: (s["start"], -s["end"])):
                    if s["end"] <= at:
                        continue
                    parts += [text[at : max(at, s["start"])], f"<{KINDS[s['kind']].upper()}>" if s["start"] >= at else ""]
                    at = s["end"]
                out.append("".join(parts) + text[at:])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), batch.column("text_key"), pa.array(out, pa.string())],
                ["doc", "text_key", "masked"],
            )


def masked(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc, text_key, masked)`` of the rows with personal data."""
    found = find_personal_data(docs, doc_id, text).filter("size(spans) > 0")
    found = found.select(F.col("doc").alias("d"), F.col("text_key").alias("k"), "spans").dropDuplicates(["d", "k"])
    texts = docs.select(
        F.col(doc_id).cast("bigint").alias("doc"), text_key(F.col(text)).alias("text_key"), F.col(text).alias("text")
    )
    rows = texts.join(found, (F.col("text_key") == F.col("k")) & F.col("doc").eqNullSafe(F.col("d")))
    return rows.select("doc", "text_key", "text", "spans").mapInArrow(Mask(), "doc bigint, text_key bigint, masked string")
