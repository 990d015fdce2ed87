"""Document fingerprints: a homomorphic hash of the multiset of a text's paragraphs.

Every paragraph is hashed to a vector with a lane per hash bit and a few wide lanes, weighted by its
length; vectors add lane by lane modulo 2^32 (wide lanes modulo 2^62). The sum does not depend on order, and a
paragraph is inserted or deleted by adding or subtracting its vector. The bits act as random signs, so the
distance of two sums estimates the distance of the multisets. Built-in expressions throughout.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.llm.common import fresh, text_or_empty

#: A paragraph ends at a line break; one line of prose is cut after its sentences, so that it has parts to compare.
PARAGRAPH_END = r"\n|(?<=[.!?])\x20"
#: A longer paragraph is hashed in stretches of this many code points, so that a change in it leaves the others.
PIECE_CHARS = 100
SIGN_BITS = 128
#: Two lanes of 32 bits share one long: bit k of a hash in the low half, bit k + 32 in the high half. Two hashes.
_PAIR = (1 << 32) + 1
_LOW = (1 << 32) - 1
_WIDE_SALTS = (101, 202)
_SECOND_SALT = 303
_WIDE_MODULUS = (1 << 62) - 1
#: Text per range of ids, unless that made more ranges than ``MOST_RANGES``, whose borders are part of the plan.
RANGE_BYTES = 2 << 20
MOST_RANGES = 1 << 18


def paragraphs(text: Column) -> Column:
    """The parts that are hashed: paragraphs, long ones in stretches."""
    stretches = F.lit(f"(?s).{{1,{PIECE_CHARS}}}")

    def cut(p: Column) -> Column:
        long = F.char_length(p) > PIECE_CHARS
        return F.when(long, F.regexp_extract_all(p, stretches, F.lit(0))).otherwise(F.array(p))

    return F.flatten(F.transform(F.filter(F.split(text, PARAGRAPH_END), lambda p: p != ""), cut))


def with_vectors(df: DataFrame, **texts: str) -> DataFrame:
    """``df`` with, for each ``name="text column"``, the fingerprint ``name`` and the text's weight ``name_weight``.

    A fingerprint is an array of longs: 64 with two sign lanes each, then the wide lanes. Lanes are sums of
    lengths (wide lanes: of 31-bit hashes), which a text of under 2^31 characters cannot overflow. A null or
    empty text has all lanes zero. The weight is the length of all paragraphs.
    """
    zero = F.lit(0).cast("long")
    low31 = F.lit((1 << 31) - 1)

    def hashed(p: Column) -> Column:
        first = F.xxhash64(p)
        return F.struct(
            first.alias("h"),
            F.xxhash64(first, F.lit(_SECOND_SALT)).alias("g"),
            F.char_length(p).cast("long").alias("w"),
        )

    def pair(k: int):
        bits, shift = ("h", k) if k < 32 else ("g", k - 32)
        return lambda total, p: total + p["w"] * F.shiftrightunsigned(p[bits], shift).bitwiseAND(F.lit(_PAIR))

    def wide(salt: int):
        return lambda total, p: total + F.xxhash64(p["h"], F.lit(salt)).bitwiseAND(low31)

    # The hashes are a column of their own, so that the lanes read them instead of hashing again.
    parts = {name: fresh(df, f"{name}_parts") for name in texts}
    df = df.withColumns({parts[n]: F.transform(paragraphs(text_or_empty(t)), hashed) for n, t in texts.items()})
    lanes = {
        n: F.array(
            *[F.aggregate(parts[n], zero, pair(k)) for k in range(SIGN_BITS // 2)],
            *[F.aggregate(parts[n], zero, wide(salt)) for salt in _WIDE_SALTS],
        )
        for n in texts
    }
    weights = {f"{n}_weight": F.aggregate(parts[n], zero, lambda total, p: total + p["w"]) for n in texts}
    return df.withColumns(lanes | weights).drop(*parts.values())


def _lanewise(a: Column, b: Column, sign: int) -> Column:
    pairs = SIGN_BITS // 2

    def halves(x: Column, y: Column) -> Column:
        low = (x.bitwiseAND(F.lit(_LOW)) + sign * y.bitwiseAND(F.lit(_LOW))).bitwiseAND(F.lit(_LOW))
        high = F.shiftrightunsigned(x, 32) + sign * F.shiftrightunsigned(y, 32)
        return F.shiftleft(high.bitwiseAND(F.lit(_LOW)), 32).bitwiseOR(low)

    def wide(x: Column, y: Column) -> Column:
        return (x + sign * y).bitwiseAND(F.lit(_WIDE_MODULUS))

    return F.concat(
        F.zip_with(F.slice(a, 1, pairs), F.slice(b, 1, pairs), halves),
        F.zip_with(F.slice(a, pairs + 1, 2), F.slice(b, pairs + 1, 2), wide),
    )


def insert(fingerprint: Column, added: Column) -> Column:
    """The vector of a text with further paragraphs, from both vectors alone."""
    return _lanewise(fingerprint, added, 1)


def delete(fingerprint: Column, removed: Column) -> Column:
    """The vector of a text without paragraphs it holds, from both vectors alone."""
    return _lanewise(fingerprint, removed, -1)


def as_string(fingerprint: Column) -> Column:
    """Sixteen hex digits a long."""
    return F.array_join(F.transform(fingerprint, lambda x: F.lpad(F.hex(x), 16, "0")), "")


def signed_lanes(fingerprint: Column, total: Column) -> Column:
    """The lanes with bits read as signs: twice the weight of paragraphs whose bit is 1, less the whole weight."""
    pairs = F.slice(fingerprint, 1, SIGN_BITS // 2)
    lows = F.transform(pairs, lambda x: 2 * x.bitwiseAND(F.lit(_LOW)) - total)
    highs = F.transform(pairs, lambda x: 2 * F.shiftrightunsigned(x, 32) - total)
    return F.transform(F.concat(lows, highs), lambda x: x.cast("double"))


def likeness(a: Column, b: Column) -> Column:
    """From signed lanes, 1 for equal multisets and about 0 for texts that share nothing.

    The lanes' product estimates the weight the two share and their squares each text's own; the ratio to the
    larger one is cut to 0..1. Two empty texts are alike, an empty and another one are not.
    """
    zero = F.lit(0.0)
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x * y), zero, lambda s, x: s + x)
    norm_a = F.aggregate(a, zero, lambda s, x: s + x * x)
    norm_b = F.aggregate(b, zero, lambda s, x: s + x * x)
    larger = F.greatest(norm_a, norm_b)
    return F.when(a == b, F.lit(1.0)).when(larger == 0, zero).otherwise(
        F.greatest(zero, F.least(F.lit(1.0), dot / larger))
    )


def edited(text: Column, following: Column) -> Column:
    """The last half of the text (rounded down) replaced by as many first code points of the following one."""
    n = F.char_length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.left(text, n - half), F.left(following, half))


def _constants(values: list, kind: str) -> Column:
    """A constant array from one string, which is folded when the plan is made; a literal per value would take minutes."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast(f"array<{kind}>")


def with_following(df: DataFrame, carried: tuple[str, ...] = ()) -> DataFrame:
    """Rows of ``doc_id``, ``text`` with ``following``: ``text`` and the ``carried`` columns of the next row.

    Next by ascending id, and the first row follows the last. Rows are dealt into ranges of ids whose borders are ids of
    rows (exact ranks do not matter), about ``RANGE_BYTES`` of text each; the row at a border also goes to the
    range before, where it only follows. So each text moves once, and no task sorts more than a range. Null ids come
    first, repeated ids are ordered by text. A table of one row is followed by itself.
    """
    slim = df.select("doc_id", "text")
    volume = slim.agg(F.sum(F.octet_length("text")).alias("bytes"), F.min("doc_id").alias("first")).first()
    ranges = min(MOST_RANGES, max(1, math.ceil((volume["bytes"] or 0) / RANGE_BYTES)))
    borders: list[int] = []
    if ranges > 1:
        steps = _constants([i / ranges for i in range(1, ranges)], "double")
        found = slim.agg(F.percentile_approx("doc_id", steps, max(10_000, 4 * ranges))).first()[0] or []
        borders = sorted({x for x in found if x > volume["first"]})
    has_null = not slim.where("doc_id is null").isEmpty()
    table = _constants(borders, "bigint") if borders else F.array().cast("array<bigint>")
    low, high = F.lit(0), F.lit(len(borders))
    bounds = F.struct(low.alias("low"), high.alias("high"))

    def halve(state: Column, _: Column) -> Column:
        middle = F.floor((state["low"] + state["high"]) / 2).cast("int")
        done = state["low"] >= state["high"]
        above = F.try_element_at(table, middle + 1) <= F.col("doc_id")
        return F.struct(
            F.when(~done & above, middle + 1).otherwise(state["low"]).alias("low"),
            F.when(~done & ~above, middle).otherwise(state["high"]).alias("high"),
        )

    rounds = F.sequence(F.lit(1), F.lit(max(1, len(borders).bit_length())))
    place = F.when(F.col("doc_id").isNull(), 0).otherwise(F.aggregate(rounds, bounds, halve)["low"])
    at_border = (F.col("range") > 0) & (F.col("doc_id") == F.try_element_at(table, F.col("range").cast("int")))
    first = F.col("doc_id").isNull() if has_null else F.col("doc_id") == F.lit(volume["first"])
    ghost = F.when(at_border, F.col("range") - 1).when(first, F.lit(len(borders)))
    own = F.struct(F.col("range").alias("to"), F.lit(0).alias("turn"))
    copy = F.struct(ghost.alias("to"), F.lit(1).alias("turn"))
    dealt = (
        df.withColumn("range", place.cast("int"))
        .withColumn("seat", F.explode(F.when(ghost.isNull(), F.array(own)).otherwise(F.array(own, copy))))
        .withColumns({"to": F.col("seat.to"), "turn": F.col("seat.turn")})
    )
    order = Window.partitionBy("to").orderBy("turn", F.col("doc_id").asc_nulls_first(), "text")
    ahead = [F.lead(c).over(order).alias(c) for c in ("text", *carried)]
    return dealt.withColumn("following", F.struct(*ahead)).where("turn = 0").select(*df.columns, "following")


def compare_edits(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document's fingerprint beside those of its edited text and of the following document.

    ``doc_id``, ``n_chars``, ``edited`` (text), ``fingerprint``, ``edited_fingerprint`` (vectors), ``near_edited``,
    ``near_next``. An empty table gives no rows; other columns are not read.
    """
    slim = docs.select(F.col(doc_id).alias("doc_id"), text_or_empty(text).alias("text"))
    paired = with_following(with_vectors(slim, own="text"), carried=("own", "own_weight"))
    paired = with_vectors(paired.withColumn("edited", edited(F.col("text"), F.col("following.text"))), changed="edited")
    paired = paired.withColumns(
        {
            "own_signs": signed_lanes(F.col("own"), F.col("own_weight")),
            "changed_signs": signed_lanes(F.col("changed"), F.col("changed_weight")),
            "next_signs": signed_lanes(F.col("following.own"), F.col("following.own_weight")),
        }
    )
    return paired.select(
        "doc_id",
        F.char_length("text").cast("long").alias("n_chars"),
        "edited",
        F.col("own").alias("fingerprint"),
        F.col("changed").alias("edited_fingerprint"),
        likeness(F.col("own_signs"), F.col("changed_signs")).alias("near_edited"),
        likeness(F.col("own_signs"), F.col("next_signs")).alias("near_next"),
    )
