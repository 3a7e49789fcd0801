"""Secret scan with code-point spans, all in native expressions.

Three base patterns find assigned secrets, access keys and hexadecimal keys. The entropy
method adds strings that look random: a window slides over a candidate, the counts of the
one character that leaves and the one that enters update the sum of ``c * log2 c``, and the
candidate is a secret if some window's Shannon entropy reaches the bound of the candidate's
character class. Candidates on the allow list are left alone.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed patterns of the base scan.
ASSIGN = (
    r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
# A run is either taken whole or fails whole, so the least length can stand in the pattern.
ACCESS = r"AKIA[A-Z0-9]{12,}+"
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}+"

KINDS = ("assign", "access", "hex", "entropy")
_SPANS = "array<struct<start:int,kind:int,end:int>>"
_SCAN = f"struct<pos:int,found:{_SPANS}>"


@dataclass(frozen=True)
class CharacterClass:
    """Strings of one alphabet: ``pattern`` has one candidate per match. A window of
    ``window`` characters needs ``bits`` of entropy."""

    pattern: str
    window: int
    bits: float


#: Hexadecimal keys of any case, without the lower-case ones of the base scan's length, and keys
#: of letters, digits and the signs of base64; both need a digit and a letter.
CLASSES = (
    CharacterClass(
        r"(?<![A-Za-z0-9+/_=-])(?=[0-9]*+[A-Fa-f])(?=[A-Fa-f]*+[0-9])"
        r"(?![0-9a-f]{32,}+(?![A-Za-z0-9+/_=-]))"
        r"[0-9a-fA-F]{20,}+(?![A-Za-z0-9+/_=-])",
        16,
        3.0,
    ),
    CharacterClass(
        r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*+[0-9])(?=[0-9+/_=-]*+[A-Za-z])"
        r"(?![0-9a-fA-F]++(?![A-Za-z0-9+/_=-]))[A-Za-z0-9+/_=-]{20,}+",
        20,
        3.7,
    ),
)
#: Strings that look random and are no secrets: UUIDs, dates, words joined by signs with
#: numbers, digests named as such, documented examples, plain sequences.
ALLOW = (
    r"^[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$",
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}",
    r"^/?(?:(?:[A-Za-z]?[a-z]*|[A-Z]+|[0-9]+)[/_=+-]+)+(?:[A-Za-z]?[a-z]*|[A-Z]+|[0-9]+)/?$",
    r"^(?:sha|md)[0-9]+[-_=]",
    r"(?i)example|sample|abcdefgh|01234567|12345678",
)


def _scan(text: Column, pattern: str, kind: int, keep: Callable[[Column, Column], Column],
          group: int = 0) -> Column:
    """Spans of the leftmost non-overlapping matches for which ``keep(match, group)`` holds.

    Matches and the pieces between them alternate, so their lengths give the places.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.arrays_zip(
        F.slice(F.split(text, pattern), F.lit(1), F.size(found)).alias("before"),
        found.alias("match"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("group"),
    )

    def step(acc: Column, x: Column) -> Column:
        start = acc["pos"] + F.length(x["before"])
        end = start + F.length(x["match"])
        span = F.array(F.struct(start, F.lit(kind), end)).cast(_SPANS)
        more = F.when(keep(x["match"], x["group"]), F.concat(acc["found"], span))
        return F.struct(end, more.otherwise(acc["found"])).cast(_SCAN)

    start = F.struct(F.lit(0), F.array().cast(_SPANS)).cast(_SCAN)
    spans = F.aggregate(parts, start, step, lambda acc: acc["found"])
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast(_SPANS))


def _term(count: Column) -> Column:
    return F.when(count > 1, count * F.log2(count)).otherwise(0.0)


def _count(char: Column, window: Column) -> Column:
    return F.length(window) - F.length(F.replace(window, char, F.lit("")))


def largest_entropy(text: Column, window: int) -> Column:
    """Largest Shannon entropy in bits of a window of ``text``; 0 if it is shorter.

    One step a character. The window and its sum travel with the fold, so a step costs the
    window's length and a text its own length, however long.
    """

    def step(acc: Column, entering: Column) -> Column:
        old = acc["window"]
        full = F.length(old) >= window
        gone = _count(F.substring(old, F.lit(1), F.lit(1)), old)
        kept = F.when(full, F.substring(old, F.lit(2), F.lit(window))).otherwise(old)
        entered = _count(entering, kept)
        total = (
            acc["total"]
            + F.when(full, _term(gone - 1) - _term(gone)).otherwise(0.0)
            + _term(entered + 1)
            - _term(entered)
        )
        whole = F.length(kept) >= window - 1
        return F.struct(
            total.alias("total"),
            F.when(whole, F.least(acc["least"], total)).otherwise(acc["least"]).alias("least"),
            F.concat(kept, entering).alias("window"),
        )

    most = window * math.log2(window)
    start = F.struct(
        F.lit(0.0).alias("total"), F.lit(most).alias("least"), F.lit("").alias("window")
    )
    return F.aggregate(
        F.regexp_extract_all(text, F.lit("(?s)(.)"), F.lit(1)),
        start,
        step,
        lambda acc: F.lit(math.log2(window)) - acc["least"] / window,
    )


def entropy_spans(
    text: Column, classes: Sequence[CharacterClass] = CLASSES, allow: Sequence[str] = ALLOW
) -> Column:
    """Spans of the candidates that reach the entropy of their class."""
    allowed = "|".join(f"(?:{p})" for p in allow) if allow else r"(?!)"
    return F.concat(
        *[
            _scan(
                text,
                c.pattern,
                len(KINDS) - 1,
                lambda match, _, c=c: ~match.rlike(allowed)
                & (largest_entropy(match, c.window) >= c.bits),
            )
            for c in classes
        ]
    )


def base_spans(text: Column) -> Column:
    """Spans of the three base kinds. Of an assignment the whole match counts, if the value
    has 8 characters or more."""
    yes = F.lit(True)
    return F.concat(
        _scan(text, ASSIGN, 0, lambda _, value: F.length(value) >= 8, group=1),
        _scan(text, ACCESS, 1, lambda *_: yes),
        _scan(text, HEX, 2, lambda *_: yes),
    )


def _written(spans: Column) -> Column:
    name = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", F.element_at(name, s["kind"] + 1), s["start"], s["end"])
        ),
        ",",
    )


def find_secrets(
    df: DataFrame, text: str = "text", classes: Sequence[CharacterClass] = CLASSES,
    allow: Sequence[str] = ALLOW,
) -> DataFrame:
    """Add ``base`` and ``spans``: arrays of (start, kind, end) in code points, end exclusive,
    by start, then kind as in ``KINDS``.

    Null and empty texts have no spans. An entropy span that overlaps a base span is not
    added. Input columns of these two names are replaced.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    out = df.withColumn("base", F.array_sort(base_spans(whole)))
    out = out.withColumn("spans", entropy_spans(whole, classes, allow))
    more = F.filter(
        "spans",
        lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])),
    )
    return out.withColumn(
        "spans",
        F.when(F.size("spans") > 0, F.array_sort(F.concat("base", more))).otherwise(F.col("base")),
    )


def secret_digest(docs: DataFrame) -> DataFrame:
    """Per document: ``doc_id, n_assign, n_access, n_hex, base_sha256, spans``."""
    found = find_secrets(docs.select("doc_id", "text"))
    kinds = F.transform("base", lambda s: s["kind"])
    of_kind = [
        (F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{name}")
        for k, name in enumerate(KINDS[:3])
    ]
    return found.select(
        "doc_id",
        *of_kind,
        F.sha2(_written(F.col("base")), 256).alias("base_sha256"),
        _written(F.col("spans")).alias("spans"),
    )
