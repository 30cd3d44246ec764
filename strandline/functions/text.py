"""Text scalars: clean-up, postcodes, sentiment, fuzzy hashes, trigrams, tokens, coordinates."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructType

from strandline.functions.binding import let

POSTCODE = r"[A-Z]{1,2}[0-9R][0-9A-Z]? [0-9][ABD-HJLNP-UW-Z]{2}"
STRICT_POSTCODE = r"(?i)^(?:(?:[A-PR-UWYZ][0-9][0-9]?|[A-PR-UWYZ][A-HK-Y][0-9][0-9]?|[A-PR-UWYZ][0-9][A-HJKS-UW]|[A-PR-UWYZ][A-HK-Y][0-9][A-Z]) *[0-9][ABD-HJLNP-UW-Z]{2}|GIR *0AA)$"
MOODS = ("Very Negative", "Negative", "Mildly Negative", "Neutral", "Mildly Positive", "Positive", "Very Positive")
LEXICON = {"good": 3, "great": 3, "excellent": 3, "happy": 3, "love": 3, "like": 2, "nice": 3, "best": 3, "win": 4, "bad": -3, "poor": -2, "awful": -3, "sad": -2, "hate": -3, "worst": -3, "loss": -3, "fail": -2, "problem": -2, "angry": -3}


def trim_space(c: Column) -> Column:
    """Runs of blanks, tabs and line feeds as one blank, or one line feed if they hold any; none in front."""
    c = F.regexp_replace(c, r"[ \t]*\n[ \t\n]*", "\n")
    return F.ltrim(F.regexp_replace(c, r"[ \t]+", " ")).alias("text")


def postcodes(c: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(c, F.lit(POSTCODE), F.lit(0)))


def district(postcode: Column) -> Column:
    return F.regexp_replace(postcode, " [^ ]*$", "")


def is_postcode(c: Column) -> Column:
    return c.rlike(STRICT_POSTCODE)


def sentiment(c: Column, lexicon: dict[str, int] | None = None) -> Column:
    """sgn(s) * ln(1 + |s|) / 40 of the sum s of the lexicon's weights over the first 10 000 characters."""
    pairs = [F.lit(x) for kv in (lexicon or LEXICON).items() for x in kv]
    words = F.split(F.lower(F.substring(c, 1, 10_000)), r"[^\p{L}]+")
    table = F.create_map(*pairs)
    total = F.aggregate(words, F.lit(0), lambda a, w: a + F.coalesce(F.try_element_at(table, w), F.lit(0)))
    return F.signum(total) * F.log1p(F.abs(total)) / 40


def mood(score: Column) -> Column:
    """One of seven labels."""
    i = F.greatest(F.lit(0), F.least(F.lit(6), F.floor(7 * (0.5 + score)))).cast("int")
    return F.element_at(F.array(*[F.lit(m) for m in MOODS]), i + 1)


def fuzzy_text(c: Column) -> Column:
    """What the fuzzy hash sees: single blanks, lower case, no blanks around."""
    return F.trim(F.lower(F.regexp_replace(c, r"\s+", " ")))


_B64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"


_START, _PRIME = 0x27, 0x13  # the low six bits of the hash's start and prime: no others reach a signature
_STEP = np.array([[(_PRIME * x >> k) & 1 for x in range(1 << k)] + [0] * (64 - (1 << k)) for k in range(6)], np.uint8)  # bit k of a product but for bit k of x


def _rolling(points: np.ndarray) -> np.ndarray:
    """The rolling hash after each byte; it depends on the last seven."""
    roll = np.zeros(len(points), np.uint32)
    shifted = np.zeros(len(points), np.uint32)
    wide = points.astype(np.uint32)
    for k in range(min(7, len(points))):
        last = wide[: len(wide) - k]
        roll[k:] += last * np.uint32(8 - k)
        shifted[k:] ^= last << np.uint32(5 * k)
    return roll + shifted


def _piece_hashes(points: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The low six bits of the hash of each piece, the last of its bytes being at ends.

    Multiplying by an odd number leaves a bit's own place alone but for what lower bits carry, so each bit is a running
    parity once the lower ones are known.
    """
    points = points[: ends[-1] + 1]
    starts = np.r_[0, ends[:-1] + 1]
    state = np.zeros(len(points), np.uint8)
    before = np.empty(len(points), np.uint8)
    for k in range(6):
        before[1:] = state[:-1]
        before[starts] = _START & ((1 << k) - 1)
        bit = _STEP[k][before] ^ ((points >> k) & 1)
        bit[starts] ^= _START >> k & 1
        parity = np.bitwise_xor.reduceat(bit, starts)
        bit[starts[1:]] ^= parity[:-1]
        state |= np.bitwise_xor.accumulate(bit) << k
    return state[ends]


def fuzzy_hash(data: bytes) -> tuple[int, str, str]:
    """Context-triggered piecewise hash: block size, and signatures at it and at twice it."""
    size = 3
    while size * 64 < len(data):
        size *= 2
    if not data:
        return size, "", ""
    points = np.frombuffer(data, np.uint8)
    roll = _rolling(points)
    rest = [len(data) - 1] if roll[-1] else []

    def ends(size: int) -> np.ndarray:
        return np.flatnonzero(roll % np.uint32(size) == size - 1)

    def signature(triggers: np.ndarray) -> str:
        # what follows the last trigger is hashed from the start again, nothing at all if it is the last byte
        own = triggers[triggers < len(data) - 1] if rest else triggers
        text = [_B64[x] for x in _piece_hashes(points, np.r_[own, rest].astype(np.int64))] if len(own) or rest else []
        if rest and len(own) < len(triggers):
            text.append(_B64[_START])
        return "".join(text)

    one = ends(size)
    while size > 3 and min(len(one), 63) + len(rest) < 32:
        size //= 2
        one = ends(size)
    two = one[roll[one] % np.uint32(2 * size) == 2 * size - 1]
    return size, signature(one[:63]), signature(two[:31])


@F.arrow_udf(StructType().add("bs", IntegerType()).add("h1", StringType()).add("h2", StringType()))
def fuzzy(text: pa.Array) -> pa.Array:
    rows = [fuzzy_hash((t.as_py() or "").encode()) for t in text]
    kinds = (pa.int32(), pa.string(), pa.string())
    return pa.StructArray.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], ["bs", "h1", "h2"])


def fuzzy_line(h: Column, name: Column) -> Column:
    """bs:h1:h2:name"""
    return F.concat_ws(":", h["bs"].cast("string"), h["h1"], h["h2"], name)


def trigrams(c: Column) -> Column:
    """Windows of three over the lower-cased text with everything but letters as underscore."""
    return _windows(F.regexp_replace(F.lower(c), r"[^\p{L}]", "_"), 3, 3)


def _windows(c: Column, low: int, high: int) -> Column:
    """All runs of low to high characters; the characters are split off once, as finding one by position takes its place in steps."""
    one = lambda s, n: F.slice(F.transform(s, lambda _, i: F.array_join(F.array(*[F.get(s, i + k) for k in range(n)]), "")), F.lit(1), F.greatest(F.size(s) - (n - 1), F.lit(0)))
    letters = F.filter(F.split(F.coalesce(c, F.lit("")), ""), lambda x: x != "")
    return let(letters, lambda s: F.flatten(F.array(*[one(s, n) for n in range(low, high + 1)])))


def terms(c: Column, synonyms: dict[str, list[str]] | None = None) -> Column:
    """Lower-case runs of letters and digits; each is followed by its synonyms, if it has any."""
    words = F.filter(F.split(F.lower(c), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    if not synonyms:
        return words
    pairs = [x for word, others in sorted(synonyms.items()) for x in (F.lit(word), F.array(*[F.lit(o) for o in others]))]
    table = F.create_map(*pairs)
    none = F.array().cast("array<string>")
    return F.flatten(F.transform(words, lambda w: F.concat(F.array(w), F.coalesce(F.try_element_at(table, w), none))))


def path_levels(c: Column, separator: str = "/") -> Column:
    """A path and all paths above it, the shortest first."""
    parts = F.filter(F.split(c, separator), lambda x: x != "")
    each = lambda p: F.transform(F.sequence(F.lit(1), F.size(p)), lambda i: F.array_join(F.slice(p, F.lit(1), i), separator))
    return let(parts, lambda p: F.when(F.size(p) == 0, F.array().cast("array<string>")).otherwise(each(p)))


def ngrams(c: Column, low: int = 2, high: int = 5) -> Column:
    """All substrings of low to high characters."""
    return _windows(c, low, high)


_DMS = r"(-?[0-9.,]+)°\s*([0-9.,]+)'\s*([0-9.,]+)"


def degrees(c: Column) -> Column:
    """Decimal degrees of degrees, minutes and seconds; a plain number as it is; null if neither."""
    part = lambda i: F.replace(F.regexp_extract(c, _DMS, i), F.lit(","), F.lit(".")).try_cast("double")
    size = F.abs(part(1)) + part(2) / 60 + part(3) / 3600
    return F.when(c.rlike(_DMS), F.when(c.startswith("-"), -size).otherwise(size)).otherwise(c.try_cast("double"))


def location(lat: Column, lon: Column) -> Column:
    """``lat,lon``; null at zero and out of range."""
    good = (lat != 0) & (lon != 0) & lat.between(-90, 90) & lon.between(-180, 180)
    return F.when(good, F.concat_ws(",", lat.cast("string"), lon.cast("string")))


def generators(*values: Column) -> Column:
    """Distinct non-null software names, without the prefix that PNG text chunks have."""
    clean = [F.regexp_replace(v, r"(?i)^keyword=software, value=", "") for v in values]
    return F.array_distinct(F.filter(F.array(*clean), lambda v: v.isNotNull()))


