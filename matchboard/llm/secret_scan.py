"""Secrets in texts, by patterns and by the entropy of sliding windows; DataFrame functions only.

Base kinds are patterns: assignments of a value to a secret-like name, access key ids, and long hexadecimal
strings. Their spans are always reported.

Further spans come from candidate strings of a character class. A window slides over the candidate, and the
count of each character in it is kept up to date as one character enters and one leaves. With n the window
length, the Shannon entropy is log2(n) - sum(c * log2(c)) / n, so only the sum has to follow the counts; it is
kept in whole millionths. The reported span runs from the first window above the class's threshold to the end
of the last. Candidates of a shape on the allow-list are left out, and so are spans that hold its words.

Positions are code points, the end is exclusive. Null texts count as empty and have no spans; repeated rows
and null ids are scanned like any other. An empty table gives an empty result. ``with_spans`` keeps all
columns and adds one, whose name the caller chooses; a column of that name is replaced.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchboard.llm.common import text_of

# The base patterns and the least length of what they must match.
ASSIGN = r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
ASSIGN_VALUE, ACCESS_LENGTH, HEX_LENGTH = 6, 20, 24

MILLION = 1_000_000


@dataclass(frozen=True)
class EntropyClass:
    """Candidates are runs of ``alphabet``; a window above ``bits`` per character is a finding."""

    kind: str
    alphabet: str
    pattern: str
    window: int
    bits: float


LOWER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "0123456789"
CLASSES = (
    EntropyClass("entropy_hex", DIGITS + "abcdefABCDEF", r"[0-9a-fA-F]{24,}", 24, 3.0),
    EntropyClass("entropy_base64", LOWER.upper() + LOWER + DIGITS + "+/_-", r"[A-Za-z0-9+/_-]{20,}", 20, 3.7),
)

# Candidates that are not secrets, whatever their entropy.
ALLOWED_RUNS = (
    r"^[A-Za-z_/+-]+$",  # no digit: long words, paths
    r"^[0-9]+$",  # plain numbers
    r"^[A-Za-z]+[0-9]{1,4}$",  # a word with a number
    r"^(?:[A-Za-z]+[-_/])+[A-Za-z0-9]{1,8}$",  # slugs and file names
    r"^[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$",  # UUID
)

# Found spans that look random and are documentation; elsewhere in a candidate the same words mean nothing.
ALLOWED_SPAN = r"(?i)example|sample|placeholder|xxxx|0123456789|abcdefghij"

KINDS = ("assign", "access", "hex") + tuple(c.kind for c in CLASSES)


def _starts(parts: Column, found: Column) -> Column:
    """Where each match begins, from the texts between the matches and the matches themselves."""
    step = F.transform(
        F.sequence(F.lit(1), F.size(found)),
        lambda i: F.struct(F.length(F.element_at(parts, i)).alias("gap"), F.length(F.element_at(found, i)).alias("own")),
    )
    first = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
    walked = F.aggregate(
        step,
        first,
        lambda acc, x: F.struct(
            (acc["at"] + x["gap"] + x["own"]).alias("at"), F.concat(acc["out"], F.array(acc["at"] + x["gap"])).alias("out")
        ),
    )
    return F.when(F.size(found) > 0, walked["out"]).otherwise(F.array().cast("array<int>"))


def _span(start: Column, end: Column, kind: str) -> Column:
    return F.struct(start.cast("int").alias("start"), F.lit(KINDS.index(kind)).alias("rank"), end.cast("int").alias("end"))


def _no_spans() -> Column:
    return F.array().cast("array<struct<start:int,rank:int,end:int>>")


def _entropy_spans(token: Column, at: Column, cls: EntropyClass) -> Column:
    n = cls.window
    gain = [round(c * math.log2(c) * MILLION) if c else 0 for c in range(n + 1)]
    ceiling = math.floor(n * (math.log2(n) - cls.bits) * MILLION)  # the sum of a window above the threshold
    steps = F.array(*[F.lit(gain[c + 1] - gain[c]).cast("long") for c in range(n)])

    def slide(places: Column, acc: Column, i: Column) -> Column:
        enters, leaves = acc["enters"], acc["leaves"]
        change = lambda place, by: F.when(place, by).otherwise(0)
        counts = F.transform(acc["counts"], lambda c, j: c + change(j + 1 == enters, 1) - change(j + 1 == leaves, 1))
        after = F.when(leaves > 0, acc["sum"] - F.element_at(steps, F.element_at(acc["counts"], F.greatest(leaves, F.lit(1))))).otherwise(acc["sum"])
        total = after + F.element_at(steps, F.element_at(counts, enters))
        hot = (i >= n) & (total <= ceiling)
        return F.struct(
            counts.alias("counts"),
            total.alias("sum"),
            F.when(hot & (acc["first"] == 0), i).otherwise(acc["first"]).alias("first"),
            F.when(hot, i).otherwise(acc["last"]).alias("last"),
            F.coalesce(F.get(places, i), F.lit(0)).alias("enters"),
            F.when(i >= n, F.get(places, i - n)).otherwise(F.lit(0)).alias("leaves"),
        )

    def zero(places: Column) -> Column:
        return F.struct(
            F.array_repeat(F.lit(0), len(cls.alphabet)).alias("counts"),
            F.lit(0).cast("long").alias("sum"),
            F.lit(0).alias("first"),
            F.lit(0).alias("last"),
            F.get(places, F.lit(0)).alias("enters"),
            F.lit(0).alias("leaves"),
        )

    # the candidate is taken apart once; a character is then looked up by its place
    places = F.transform(F.split(token, ""), lambda c: F.instr(F.lit(cls.alphabet), c))
    runs = F.transform(F.array(places), lambda p: F.aggregate(F.sequence(F.lit(1), F.length(token)), zero(p), lambda acc, i: slide(p, acc, i)))
    hot = lambda r: F.substr(token, r["first"] - n + 1, r["last"] - r["first"] + n)
    found = F.filter(runs, lambda r: (r["first"] > 0) & ~hot(r).rlike(ALLOWED_SPAN))
    return F.transform(found, lambda r: _span(at + r["first"] - n, at + r["last"], cls.kind))


def _entropy_spans_of(candidates: Column, cls: EntropyClass) -> Column:
    return F.flatten(F.transform(candidates, lambda m: _entropy_spans(m["token"], m["at"], cls)))


def with_spans(docs: DataFrame, name: str = "spans", text_col: str = "text") -> DataFrame:
    """All rows and columns, and ``name``: array<struct<start, rank, end>> in order; rank is the place in KINDS."""
    columns = [F.col(f"`{c}`") for c in docs.columns if c != name]
    texts = docs.select(*columns, text_of(text_col).alias("__scan_text"))
    text = F.col("__scan_text")
    patterns = {"assign": ASSIGN, "access": ACCESS, "hex": f"{HEX[:-1]}{{{HEX_LENGTH},}}"} | {c.kind: c.pattern for c in CLASSES}
    # a run of hexadecimal digits below the length never matches, so the length may stand in the pattern itself
    found = texts.withColumns({f"__{k}": F.regexp_extract_all(text, F.lit(p), F.lit(0)) for k, p in patterns.items()})
    parts = found.withColumns(
        {
            f"__{k}_at": _starts(
                F.when(F.size(f"__{k}") > 0, F.split(text, p, -1)).otherwise(F.array().cast("array<string>")), F.col(f"__{k}")
            )
            for k, p in patterns.items()
        }
    )

    def base(kind: str, enough) -> Column:
        all_spans = F.transform(
            F.arrays_zip(F.col(f"__{kind}").alias("token"), F.col(f"__{kind}_at").alias("at")),
            lambda m: F.when(enough(m["token"]), _span(m["at"], m["at"] + F.length(m["token"]), kind)),
        )
        return F.filter(all_spans, lambda s: s.isNotNull())

    spans = [
        base("assign", lambda t: F.length(F.regexp_extract(t, ASSIGN, 2)) >= ASSIGN_VALUE),
        base("access", lambda t: F.length(t) >= ACCESS_LENGTH),
        base("hex", lambda t: F.length(t) >= HEX_LENGTH),
    ]
    for cls in CLASSES:
        pairs = F.arrays_zip(F.col(f"__{cls.kind}").alias("token"), F.col(f"__{cls.kind}_at").alias("at"))
        spans.append(_entropy_spans_of(F.filter(pairs, lambda m: ~_allowed(m["token"])), cls))
    return parts.select(*columns, F.array_sort(F.concat(*spans)).alias(name))


def _allowed(token: Column) -> Column:
    allowed = F.lit(False)
    for pattern in ALLOWED_RUNS:
        allowed = allowed | token.rlike(pattern)
    return allowed


def _joined(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["rank"] + 1), s["start"], s["end"])), ","
    )


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    scanned = with_spans(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), "__spans")
    spans = F.col("__spans")
    n_base = 3
    count = lambda rank: F.size(F.filter(spans, lambda s: s["rank"] == rank)).cast("long")
    return scanned.select(
        "doc_id",
        *[count(rank).alias(f"n_{KINDS[rank]}") for rank in range(n_base)],
        F.sha2(_joined(F.filter(spans, lambda s: s["rank"] < n_base)), 256).alias("base_sha256"),
        _joined(spans).alias("spans"),
    )


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The same rows and columns; every found span in the text becomes [REDACTED]. Null texts stay null.

    Store the result before scanning it again: the new text is a large expression, which a second scan would repeat.
    """
    scanned = with_spans(docs, "__spans", text_col)
    text = F.col(f"`{text_col}`")
    merged = F.aggregate(
        F.col("__spans"),
        F.array().cast("array<struct<start:int,end:int>>"),
        lambda acc, s: F.when(
            (F.size(acc) > 0) & (F.element_at(acc, -1)["end"] >= s["start"]),
            F.concat(
                F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))),
                F.array(F.struct(F.element_at(acc, -1)["start"].alias("start"), F.greatest(F.element_at(acc, -1)["end"], s["end"]).alias("end"))),
            ),
        ).otherwise(F.concat(acc, F.array(F.struct(s["start"].alias("start"), s["end"].alias("end"))))),
    )
    with_merged = scanned.withColumn("__merged", merged)
    spans = F.col("__merged")
    pieces = F.transform(
        F.sequence(F.lit(1), F.size(spans) + 1),
        lambda i: F.substr(
            text,
            F.when(i == 1, F.lit(0)).otherwise(F.get(spans, i - 2)["end"]) + 1,
            F.when(i > F.size(spans), F.length(text)).otherwise(F.get(spans, i - 1)["start"])
            - F.when(i == 1, F.lit(0)).otherwise(F.get(spans, i - 2)["end"]),
        ),
    )
    clean = F.when(F.size("__spans") > 0, F.array_join(pieces, "[REDACTED]")).otherwise(text)
    return with_merged.select(*[(clean if c == text_col else F.col(f"`{c}`")).alias(c) for c in docs.columns])
