"""Personal data: patterns propose spans, checksums confirm them, context words move the score.

Only Spark expressions, one pass over the rows, no shuffle.  Spans count code points, the end is
exclusive.  The base kinds (email, ip, card, phone) always stay; iban, short card and national phone
numbers are added when checksum and context together reach the threshold.

Texts are cut into pieces of about PIECE characters, after a character that no pattern holds or between a
space and a small letter, which no match spans; matches, context and masks are made within a piece.  A piece may be as long as
the text where it offers no such place, so parts of a piece are taken from slices of it.  Every quantifier that could run long is possessive or has a bound, and starts are tied to the edge of a
run, so that time stays linear in a text's length.

Null and empty texts have no spans; rows that repeat are found each; columns of any name pass through.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free

#: For each kind the pattern, a cheap sign that a text may hold it, the prior score, and
#: the context words that raise it.
KINDS = {
    "email": (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", 0.9, "mail|contact|write|reach"),
    "ip": (r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", ".", 0.6, "ip|host|server|address|login"),
    "card": (r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){15,18}+(?![ -]?[0-9])", "", 0.8, "card|visa|credit|payment|debit"),
    "phone": (r"\+[0-9][ ().0-9-]+[0-9]", "+", 0.7, "tel|phone|call|fax|mobile"),
    "iban": (r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}+|(?: [A-Z0-9]{4}){2,7}+(?: [A-Z0-9]{1,3})?)(?![A-Za-z0-9])", "", 0.9, "iban|bank|account|konto"),
    "card_short": (r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){12,14}+(?![ -]?[0-9])", "", 0.3, "card|visa|credit|payment|debit"),
    "phone_national": (r"(?<![0-9+])\(?[0-9]{3}\)?[ -][0-9]{3}[ -][0-9]{4}(?![0-9])", "", 0.3, "tel|phone|call|fax|mobile"),
}
BASE = ("email", "ip", "card", "phone")
CONTEXT = 40
PIECE = 4_000
#: Items of a list that are folded into one: a fold copies what it has at each step, so long lists are folded in two levels.
GROUP = 64
#: A piece ends after a character of no pattern, or between a space and a small letter.
_PIECES = r"(?s).{%d,}?(?:(?<=[^A-Za-z0-9._%%+@() -])|(?<= )(?=[a-z]))|.+" % PIECE
#: Characters of a slice: parts of a piece are put together from these, as a place in a list is found at once and one in a string is not.
SLICE = 64
RAISE = 0.3
THRESHOLD = 0.5
SPAN = "struct<kind:string,start:int,end:int,score:double>"
_LETTERS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _luhn(digits: Column) -> Column:
    twice = F.translate(digits, "0123456789", "0246813579")
    total = F.aggregate(
        F.sequence(F.lit(1), F.length(digits)),
        F.lit(0),
        lambda acc, i: acc + F.substr(F.when(i % 2 == 0, twice).otherwise(digits), F.length(digits) - i + 1, F.lit(1)).cast("int"),
    )
    return total % 10 == 0


def _mod97(value: Column) -> Column:
    plain = F.regexp_replace(value, " ", "")
    turned = F.concat(F.substr(plain, F.lit(5)), F.substr(plain, F.lit(1), F.lit(4)))

    def step(acc: Column, i: Column) -> Column:
        digit = F.instr(F.lit(_LETTERS), F.substr(turned, i, F.lit(1))) - 1
        return (acc * F.when(digit > 9, 100).otherwise(10) + digit) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), step) == 1


def _valid(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        part = lambda x: F.regexp_replace(x, "^0+", "")
        return F.forall(F.split(value, r"\."), lambda x: (F.length(part(x)) <= 3) & (F.lpad(part(x), 3, "0") <= "255"))
    if kind in ("card", "card_short"):
        return _luhn(digits)
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return _mod97(value) if kind == "iban" else F.lit(True)


def _part(slices: Column, start: Column, length: Column) -> Column:
    """So many characters of the text that the slices are of, from start on."""
    first = F.call_function("div", start, F.lit(SLICE)).cast("int")
    some = F.slice(slices, first + 1, F.call_function("div", start % SLICE + length, F.lit(SLICE)).cast("int") + 1)
    return F.substr(F.array_join(some, ""), start % SLICE + 1, length)


_MATCHES = "array<struct<start:int,end:int,value:string>>"


def _let(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of value, which is evaluated once."""
    return F.transform(F.array(value), f)[0]


def _scan(items: Column, of: str, step: Callable[[Column, Column], tuple[Column, Column]]) -> Column:
    """(at, out): step(at, item) gives the next at (from 0) and an array of of, which are put together in order."""

    def one(acc: Column, x: Column) -> Column:
        at, out = step(acc["at"], x)
        return F.struct(at.alias("at"), F.concat(acc["out"], out).alias("out"))

    def group(acc: Column, some: Column) -> Column:
        inner = F.aggregate(some, F.struct(acc["at"].alias("at"), F.array().cast(f"array<{of}>").alias("out")), one)
        return _let(inner, lambda f: F.struct(f["at"].alias("at"), F.concat(acc["out"], F.array(f["out"])).alias("out")))

    def groups(v: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / GROUP).cast("int")), lambda k: F.slice(v, k * GROUP + 1, F.lit(GROUP)))

    some = _let(items, lambda v: F.when(F.size(v) > 0, groups(v)).otherwise(F.array(v)))
    return F.aggregate(some, F.struct(F.lit(0).alias("at"), F.array().cast(f"array<array<{of}>>").alias("out")), group, lambda acc: F.struct(acc["at"].alias("at"), F.flatten(acc["out"]).alias("out")))


def _found(kind: str, piece: Column) -> Column:
    """All matches of the kind's pattern in a piece (text, slices, at, before, after), placed in the piece: what lies between
    matches gives the starts."""
    pattern, sign, prior, words = KINDS[kind]
    text = piece["text"]
    may = text.contains(sign) if sign else text.rlike("[0-9]")

    def place(at: Column, x: Column) -> tuple[Column, Column]:
        start, size = at + F.length(x["gap"]), F.length(x["value"])
        span = F.array(F.struct(start.alias("start"), (start + size).alias("end"), x["value"].alias("value")))
        return start + F.coalesce(size, F.lit(0)), F.when(size.isNull(), F.array().cast(_MATCHES)).otherwise(span)

    pairs = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("value"))
    placed = _scan(pairs, "struct<start:int,end:int,value:string>", place)["out"]

    def scored(x: Column) -> Column:
        before = F.right(F.concat(piece["before"], _part(piece["slices"], F.greatest(x["start"] - CONTEXT, F.lit(0)), F.least(x["start"], F.lit(CONTEXT)))), F.lit(CONTEXT))
        near = F.lower(F.concat_ws(" ", before, F.left(F.concat(_part(piece["slices"], x["end"], F.lit(CONTEXT)), piece["after"]), F.lit(CONTEXT))))
        score = F.lit(prior) + F.when(near.rlike(rf"\b(?:{words})"), RAISE).otherwise(0.0)
        return F.struct(F.lit(kind).alias("kind"), x["start"].alias("start"), x["end"].alias("end"), F.least(score, F.lit(1.0)).alias("score"))

    spans = F.transform(F.filter(F.when(may, placed).otherwise(F.array().cast(_MATCHES)), lambda x: _valid(kind, x["value"])), scored)
    return spans if kind in BASE else F.filter(spans, lambda s: s["score"] >= THRESHOLD)


def with_pieces(df: DataFrame, text_col: str, out_col: str) -> DataFrame:
    """df with out_col: the text's pieces, each with its place (at) and its spans, placed in the piece, by kind as listed in KINDS."""
    raw, at = free("raw", df), free("at", df)
    cut = df.withColumn(raw, F.regexp_extract_all(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), F.lit(_PIECES), F.lit(0)))
    places = _scan(F.transform(raw, F.length), "int", lambda so_far, n: (so_far + n, F.array(so_far)))["out"]
    cut = cut.withColumn(at, places)
    near = lambda k, side: F.coalesce(side(F.get(raw, k), F.lit(CONTEXT)), F.lit(""))
    pieces = F.transform(raw, lambda x, k: F.struct(x.alias("text"), F.regexp_extract_all(x, F.lit(r"(?s).{1,%d}" % SLICE), F.lit(0)).alias("slices"), F.get(at, k).alias("at"), near(k - 1, F.right).alias("before"), near(k + 1, F.left).alias("after")))
    cut = cut.withColumn(out_col, pieces).drop(raw, at)
    spans = lambda p: F.concat(*(_found(kind, p) for kind in KINDS)).cast(f"array<{SPAN}>")
    return cut.withColumn(out_col, F.transform(out_col, lambda p: F.struct(p["text"].alias("text"), p["slices"].alias("slices"), p["at"].alias("at"), spans(p).alias("spans"))))


def in_order(pieces: Column) -> Column:
    """The spans of all pieces, placed in the text: by kind as listed in KINDS, then by start."""

    def of(kind: str) -> Column:
        def placed(p: Column) -> Column:
            return F.transform(F.filter(p["spans"], _is(kind)), lambda s: F.struct(s["kind"].alias("kind"), (s["start"] + p["at"]).alias("start"), (s["end"] + p["at"]).alias("end"), s["score"].alias("score")))

        return F.flatten(F.transform(pieces, placed))

    return F.concat(*map(of, KINDS)).cast(f"array<{SPAN}>")


def with_spans(df: DataFrame, text_col: str = "text", out_col: str = "spans") -> DataFrame:
    """df with out_col: array of (kind, start, end, score), by kind as listed in KINDS, then by start."""
    pieces = free("pieces", df)
    return with_pieces(df, text_col, pieces).withColumn(out_col, in_order(F.col(pieces))).drop(pieces)


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(pieces: Column) -> Column:
    """The text of the pieces with each span, or run of overlapping spans, replaced by the first one's kind in brackets."""

    def masked(p: Column) -> Column:
        text, ordered = p["text"], F.array_sort(F.transform(p["spans"], lambda s: F.struct(s["start"], s["end"], s["kind"])))

        def step(at: Column, s: Column) -> tuple[Column, Column]:
            label = F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))
            inside = s["start"] < at
            return F.greatest(at, s["end"]), F.when(inside, F.array().cast("array<string>")).otherwise(F.array(_part(p["slices"], at, s["start"] - at), label))

        folded = _let(_scan(ordered, "string", step), lambda f: F.concat(F.array_join(f["out"], ""), F.substr(text, f["at"] + 1)))
        return F.when(F.size(p["spans"]) > 0, folded).otherwise(text)

    return F.array_join(F.transform(pieces, masked), "")


def _is(kind: str) -> Callable[[Column], Column]:
    return lambda s: s["kind"] == kind


def digest(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) of each row."""
    found = with_spans(docs.select("doc_id", "text"), out_col="found").select("doc_id", "found")
    counts = [F.size(F.filter("found", _is(kind))).cast("long").alias(f"n_{kind}") for kind in BASE]
    base = F.filter("found", lambda s: s["kind"].isin(*BASE))
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"), F.transform("found", lambda s: s["score"]).alias("scores"))


def redact(docs: DataFrame) -> DataFrame:
    """docs with the found spans masked in text and n_chars counted anew where there are any; null texts stay null, and all
    columns keep their names, whatever they are."""
    pieces = free("pieces", docs)
    some = F.exists(pieces, lambda p: F.size(p["spans"]) > 0)
    found = with_pieces(docs, "text", pieces).withColumn("text", F.when(some, redacted(F.col(pieces))).otherwise(F.col("text")))
    return found.withColumn("n_chars", F.when(some, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select([F.col(f"`{c}`") for c in docs.columns])
