"""Personal data: labelers vote on candidate spans, a latent-class model weighs them.

1. One pass over the texts finds the fixed base spans and looser candidates, and for
   every candidate the votes of its labelers (regex forms, gazetteers, words around it)
   and a few features of its shape. Both are small integers; they are written.
2. Candidates are counted by kind, votes and features: a table of bounded size however
   large the corpus, over all candidates.
3. Expectation-maximisation on these counts estimates, for each kind, how common
   personal data is and how reliable each labeler is, without labels.
4. A logistic span classifier is trained on the counts with the posteriors as soft
   labels. It decides for each combination of features and votes.
5. Base spans stay; candidates that the classifier accepts are added.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col, pieces, text_or_empty, written

KINDS = ("email", "ip", "card", "phone")
TEXT_BYTES = 1 << 23
# The base patterns.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# The same where no character that could start the match earlier stands before it.
EMAIL_FIRST = re.compile(r"(?<![A-Za-z0-9._%+-])" + EMAIL.pattern)
IP_FIRST = re.compile(r"(?<![0-9])" + IP.pattern)
# Looser forms of the same data; each match that is no base span is a candidate.
LOOSE = {
    "email": re.compile(
        r"[A-Za-z0-9._%+-]+ ?[\[({<]? ?(?:@|\bat\b) ?[\])}>]? ?[A-Za-z0-9-]+"
        r"(?: ?[\[({<]? ?(?:\.|\bdot\b) ?[\])}>]? ?[A-Za-z0-9-]+)+",
        re.IGNORECASE,
    ),
    "ip": re.compile(r"(?<![0-9A-Fa-f:.])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])"),
    "card": re.compile(r"(?<![0-9])[0-9]{4}(?:[ .\-\t/]{1,2}[0-9]{4}){3}(?![0-9])"),
    "phone": re.compile(r"(?<![0-9+.])(?:00[1-9][0-9 ().-]{6,20}[0-9]|\(?0?[0-9]{2,4}\)?[ .-][0-9]{3,4}[ .-][0-9]{3,5})(?![0-9])"),
}
# The email form where no character of a name stands before it.
LOOSE_EMAIL_FIRST = re.compile(r"(?<![A-Za-z0-9._%+-])" + LOOSE["email"].pattern, re.IGNORECASE)
# What must occur in a text for a loose form to be tried: a part of every match of the form.
LOOSE_NEEDS = {
    "email": re.compile(
        r"(?:@|\bat\b) ?[\])}>]? ?[A-Za-z0-9-]+ ?[\[({<]? ?(?:\.|\bdot\b) ?[\])}>]? ?[A-Za-z0-9-]", re.IGNORECASE
    ),
    "ip": re.compile(":[0-9A-Fa-f]{1,4}:"),
    "card": None,
    "phone": None,
}
# Gazetteers: words that stand before such data, and endings of mail hosts.
CONTEXT = {
    "email": frozenset("email e-mail mail contact write correo courriel adresse address".split()),
    "ip": frozenset("ip ipv4 ipv6 address host server client login adresse".split()),
    "card": frozenset("card credit visa mastercard amex debit payment tarjeta carte karte kreditkarte".split()),
    "phone": frozenset("phone tel telephone call mobile fax cell whatsapp telefon handy telefono teléfono téléphone".split()),
}
AGAINST = frozenset("version release build chapter section isbn order invoice page id serial figure".split())
HOST_ENDINGS = frozenset("com org net edu gov info io de fr es uk eu co us it nl ch at biz".split())
AREA_STARTS = tuple(str(n) for n in (1, 20, 27, 30, 31, 32, 33, 34, 36, 39, *range(40, 50), *range(51, 59), *range(60, 67), 7, 81, 82, 84, 86, *range(90, 96)))
CARD_STARTS = ("4", "51", "52", "53", "54", "55", "34", "37", "6011", "65", "36", "38", "35", "22", "23", "24", "25", "26", "27")
CONTEXT_CHARS = 40
WORD = re.compile(r"[\w-]+")

FORM, GAZETTEER, NEAR, CHECKED, CONTRARY = range(5)
LABELERS = 5
FEATURES = 4


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (2 if i % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(filter(str.isdigit, text))


def _byte(digits: str) -> bool:
    """Whether a number of any length is at most 255."""
    digits = digits.lstrip("0")
    return len(digits) <= 3 and int(digits or 0) <= 255


def _from_run_starts(form: re.Pattern, first: re.Pattern, text: str) -> Iterator[re.Match]:
    """Like form.finditer. What matches from inside a run of the form's first characters matches
    from the run's start too, so runs are tried once each: from there, or behind the match before."""
    at = 0
    while m := form.match(text, at) or first.search(text, at):
        yield m
        at = m.end()


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the fixed patterns; failing matches are dropped, not retried."""
    found = []
    if "@" in text:
        found += [(0, *m.span()) for m in _from_run_starts(EMAIL, EMAIL_FIRST, text)]
    # A match takes all digits of its last part, so that the next one starts at a run's start.
    found += [(1, *m.span()) for m in IP_FIRST.finditer(text) if all(map(_byte, m[0].split(".")))]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = _digits(m[0])
            if 16 <= len(digits) <= 19 and luhn(digits):
                found.append((2, *m.span()))
    if "+" in text:
        found += [(3, *m.span()) for m in PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
    return found


def _loose_matches(name: str, text: str) -> Iterator[re.Match]:
    if name == "email":
        return _from_run_starts(LOOSE[name], LOOSE_EMAIL_FIRST, text)
    return LOOSE[name].finditer(text)


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Base spans first, then loose matches that overlap no span before them."""
    found = list(base)
    taken: list[tuple[int, int]] = []  # in order, without overlaps
    for a, b in sorted((a, b) for _, a, b in base):
        if taken and a < taken[-1][1]:
            taken[-1] = (taken[-1][0], max(b, taken[-1][1]))
        else:
            taken.append((a, b))
    for kind, name in enumerate(KINDS):
        need = LOOSE_NEEDS[name]
        if need is not None and not need.search(text):
            continue
        for m in _loose_matches(name, text):
            a, b = m.span()
            at = bisect_left(taken, (b,))  # all before start ahead of b, the last of them ends last
            if not at or taken[at - 1][1] <= a:
                found.append((kind, a, b))
                taken.insert(at, (a, b))
    return found


def votes(text: str, kind: int, start: int, end: int, is_base: bool) -> tuple[int, int]:
    """The labelers' votes (base 3: abstain, no, yes) and the features (bits) of a span."""
    span, name = text[start:end], KINDS[kind]
    digits = _digits(span)
    around = {w.lower() for w in WORD.findall(text[max(0, start - CONTEXT_CHARS) : start])}
    around_after = {w.lower() for w in WORD.findall(text[end : end + CONTEXT_CHARS // 2])}
    vote = [0] * LABELERS
    # The strict form speaks for a span; a looser one says nothing.
    vote[FORM] = 2 if is_base else 0
    if name == "email":
        vote[GAZETTEER] = 2 if re.split(r"[.\s]|dot", span.lower())[-1].strip("])}> ") in HOST_ENDINGS else 1
        vote[CHECKED] = 2 if "@" in span else 0
    elif name == "ip":
        parts = span.split(".")
        vote[GAZETTEER] = 1 if parts[0] in ("0", "1", "2", "3") and len(parts) == 4 else 0
        vote[CHECKED] = 2 if all(p == "0" or not p.startswith("0") for p in parts) else 1
    elif name == "card":
        vote[GAZETTEER] = 2 if digits.startswith(CARD_STARTS) else 1
        vote[CHECKED] = 2 if luhn(digits) else 1
    else:
        number = digits[2:] if span.startswith("00") else digits
        vote[GAZETTEER] = (2 if number.startswith(AREA_STARTS) else 1) if span[0] in "+0" else 0
        vote[CHECKED] = 2 if 8 <= len(digits) <= 15 else 1
    vote[NEAR] = 2 if around & CONTEXT[name] else 0
    vote[CONTRARY] = 1 if (around | around_after) & AGAINST else 0
    packed = 0
    for v in vote:
        packed = packed * 3 + v
    features = (
        (len(span) > 16)
        | (any(c in " ()-" for c in span)) << 1
        | (start > 0 and text[start - 1].isalnum() or end < len(text) and text[end].isalnum()) << 2
        | (len(set(digits)) > 4) << 3
    )
    return packed, features


def _unpacked(packed: int) -> list[int]:
    out = []
    for _ in range(LABELERS):
        packed, v = divmod(packed, 3)
        out.append(v)
    return out[::-1]


def reliabilities(patterns: np.ndarray, counts: np.ndarray, rounds: int = 60) -> tuple[np.ndarray, float, np.ndarray]:
    """Posterior of each vote pattern, the share of personal data, and P(vote | class).

    EM for one latent class; `patterns` holds votes 0 (abstain), 1 (no), 2 (yes), which
    labelers give independently within a class. Starts from the majority vote.
    """
    yes, no = (patterns == 2).sum(1), (patterns == 1).sum(1)
    posterior = np.clip((yes + 0.5) / (yes + no + 1.0), 0.05, 0.95)
    table = np.zeros((2, LABELERS, 3))
    share = 0.5
    for _ in range(rounds):
        weights = np.stack([counts * (1 - posterior), counts * posterior])
        share = float(np.clip(weights[1].sum() / weights.sum(), 0.01, 0.99))
        for v in range(3):
            table[:, :, v] = weights @ (patterns == v) + (2.0 if v == 0 else 1.0)
        table /= table.sum(axis=2, keepdims=True)
        chosen = np.log(table[:, np.arange(LABELERS), patterns]).sum(axis=2)
        odds = chosen[1] - chosen[0] + np.log(share / (1 - share))
        posterior = 1 / (1 + np.exp(-np.clip(odds, -40, 40)))
    return posterior, share, table


def _inputs(packed: int, features: int) -> list[float]:
    given = [(-1.0, 1.0)[v - 1] if v else 0.0 for v in _unpacked(packed)]
    return [1.0, *given, *(float(features >> i & 1) for i in range(FEATURES))]


def span_classifier(rows: list[tuple[int, int, int, int]]) -> dict[tuple[int, int, int], bool]:
    """Decisions for (kind, votes, features) from the counts of all candidates."""
    accepted = {}
    for kind in range(len(KINDS)):
        own = sorted(r for r in rows if r[0] == kind)
        if not own:
            continue
        counts = np.array([r[3] for r in own], np.float64)
        soft, _, _ = reliabilities(np.array([_unpacked(r[1]) for r in own]), counts)
        x, w = np.array([_inputs(r[1], r[2]) for r in own]), counts / counts.sum()
        beta = np.zeros(x.shape[1])
        for _ in range(50):  # Newton steps with a ridge
            p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
            slope = x.T @ (w * (p - soft)) + 1e-3 * beta
            curve = (x.T * (w * p * (1 - p))) @ x + 1e-3 * np.eye(len(beta))
            beta -= np.linalg.solve(curve, slope)
        for r, score in zip(own, x @ beta):
            accepted[r[:3]] = bool(score >= 0)
    return accepted


CANDIDATE = "struct<kind:int,start:int,end:int,base:boolean,votes:int,features:int>"


def find_candidates(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, spans): candidates of each text with votes and features; offsets are code points."""
    source = docs.select(col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    schema = source.select("id", F.lit(None).cast(f"array<{CANDIDATE}>").alias("spans")).schema
    fields = [("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_()), ("votes", pa.int32()), ("features", pa.int32())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for batch in batches for p in pieces(batch, "text", TEXT_BYTES)):
            rows = []
            for text in part.column("text").to_pylist():
                base = base_spans(text)
                spans = []
                for i, (kind, a, b) in enumerate(candidates(text, base)):
                    packed, features = votes(text, kind, a, b, i < len(base))
                    spans.append((kind, a, b, i < len(base), packed, features))
                rows.append([dict(zip((n for n, _ in fields), s)) for s in spans])
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(rows, pa.list_(pa.struct(fields)))], names=["id", "spans"]
            )

    return source.mapInArrow(run, schema)


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, base and spans, arrays of (kind, start, end) ordered by kind
    and start. Offsets are code points, ends exclusive.

    `base` holds the fixed patterns' spans, `spans` those and the accepted candidates.
    NULL texts count as empty and have none. Rows are independent, repeated ones and NULL
    ids included.
    """
    found = written(find_candidates(docs, id_col, text_col))
    counted = (
        found.select(F.explode("spans").alias("s"))
        .groupBy("s.kind", "s.votes", "s.features")
        .agg(F.count("*").alias("n"))
        .collect()  # at most kinds x 3^labelers x 2^features rows
    )
    accepted = span_classifier([tuple(r) for r in counted])
    codes = [(k * 3**LABELERS + v) << FEATURES | f for (k, v, f), good in accepted.items() if good]
    spans = F.col("spans")

    def chosen(s):
        code = F.shiftleft(s["kind"] * 3**LABELERS + s["votes"], FEATURES).bitwiseOR(s["features"])
        return s["base"] | code.isin(codes) if codes else s["base"]

    def bare(s):
        return F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))

    return found.select(
        "id",
        F.array_sort(F.transform(F.filter(spans, lambda s: s["base"]), bare)).alias("base"),
        F.array_sort(F.transform(F.filter(spans, chosen), bare)).alias("spans"),
    )


def span_text(spans: Column) -> Column:
    """kind:start:end of all spans, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )
