"""Text normalisation, presence tests and set similarity as Column expressions.

Everything here stays inside the JVM: regular expressions, array functions and
arithmetic that whole-stage code generation understands.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# They must equal the source system's for the results to agree.
COMPANY_SUFFIXES = [
    "inc", "incorporated", "llc", "l.l.c", "corp", "corporation",
    "co", "company", "ltd", "limited", "pllc", "lp",
]
ADDRESS_ABBREVIATIONS = {
    "street": "st",
    "road": "rd",
    "avenue": "ave",
    "boulevard": "blvd",
    "drive": "dr",
    "suite": "ste",
}
PO_BOX = r"\bP\.?\s*O\.?\s*BOX\b"
RESIDENTIAL_RISK = r"\b(apt|apartment|unit|trlr|trailer|mobile\s*home)\b|#\s*\d+\s*$"
PLACEHOLDER_PHONE = "0000000000"

# What counts as white space when a cell is trimmed (wider than Spark's trim()).
_WS = "\t\n\u000b\f\r \u00a0\u1680" + "".join(chr(c) for c in range(0x2000, 0x200B)) + "\u2028\u2029\u202f\u205f\u3000\ufeff"

# Characters of normalised text, most frequent first, and the stand-ins for them: bytes
# 30-39, 40-49, 50-59, 60-69 (hex), whose hex form has decimal digits only.
_BY_FREQUENCY = " etaoinsrhldcumfpgwybvkjxqz0123456789"
_STAND_INS = "".join(chr(b) for tens in (0x30, 0x40, 0x50, 0x60) for b in range(tens, tens + 10))


def trim_ws(c: Column) -> Column:
    return F.btrim(c, F.lit(_WS))


def blank_to_null(c: Column) -> Column:
    return F.nullif(trim_ws(c), F.lit(""))


def truthy(c: Column) -> Column:
    """Non-null and not the empty string; white space counts as a value."""
    return F.coalesce(c != "", F.lit(False))


def filled(c: Column) -> Column:
    """Non-null with at least one character that is not white space."""
    return F.coalesce(trim_ws(c) != "", F.lit(False))


def non_empty(c: Column) -> Column:
    return F.when(c != "", c)


def nullish_to_null(c: Column) -> Column:
    """Trim a cell; a blank, NULL or None cell (any case) becomes null."""
    t = trim_ws(c)
    return F.when(~F.lower(t).isin("", "null", "none"), t)


def string_field(c: Column) -> Column:
    return blank_to_null(c.cast("string"))


def company_name(c: Column) -> Column:
    """Comparison form of a company name; empty input gives an empty string."""
    words = F.regexp_replace(F.replace(F.lower(c), F.lit("&"), F.lit(" and ")), "[^a-z0-9]+", " ")
    # "l.l.c" is in the list but can never be seen here: its dots are already gone.
    suffix = "|".join(s for s in COMPANY_SUFFIXES if "." not in s)
    padded = F.concat(F.lit(" "), words, F.lit(" "))
    bare = F.regexp_replace(F.replace(padded, F.lit("  "), F.lit(" ")), f" (?:{suffix})(?= )", "")
    return F.coalesce(F.trim(bare), F.lit(""))


def phone_digits(c: Column) -> Column:
    """Digits only; of more than ten the last ten count."""
    digits = F.regexp_replace(F.coalesce(c, F.lit("")), "[^0-9]", "")
    return F.right(digits, F.lit(10))


def street_address(c: Column) -> Column:
    """Comparison form of a street; whole words are abbreviated before punctuation goes."""
    # Every word gets a space of its own on both sides, so that plain text replacement
    # finds whole words only. "_" still joins words here, as in a regular expression.
    spaced = F.regexp_replace(F.lower(c), "[^a-z0-9_]+", "  ")
    out = F.concat(F.lit(" "), spaced, F.lit(" "))
    for word, short in ADDRESS_ABBREVIATIONS.items():
        out = F.replace(out, F.lit(f" {word} "), F.lit(f" {short} "))
    return F.coalesce(F.trim(F.regexp_replace(out, "[ _]+", " ")), F.lit(""))


def web_domain(c: Column) -> Column:
    """Lower-case host without one leading ``www.``; unparsable text is cut at ``/``."""
    rest = F.regexp_replace(trim_ws(c), r"(?i)^https?://", "")
    authority = F.regexp_extract(rest, r"^[/\\]*([^/?#\\]*)", 1)
    host_port = F.regexp_replace(authority, r"^.*@", "")
    host = F.lower(F.regexp_replace(host_port, r":[0-9]*$", ""))
    parsable = host.rlike(r"^[^\x00-\x20#/:<>?@\[\\\]^|%\x7f]+$")
    fallback = F.regexp_extract(F.regexp_replace(F.lower(c), r"^www\.", ""), r"^[^/]*", 0)
    return F.when(~truthy(c), "").otherwise(
        F.when(parsable, F.regexp_replace(host, r"^www\.", "")).otherwise(fallback)
    )


def city_state_key(city: Column, state: Column) -> Column:
    return F.when(
        truthy(city) & truthy(state),
        F.concat_ws("|", F.lower(trim_ws(city)), F.lower(trim_ws(state))),
    )


def is_po_box(c: Column) -> Column:
    return F.coalesce(c.rlike("(?i)" + PO_BOX), F.lit(False))


def is_residential_risk(c: Column) -> Column:
    return F.coalesce(c.rlike("(?i)" + RESIDENTIAL_RISK), F.lit(False))


# ---------------------------------------------------------------- similarity


def bigram_codes(normalized: Column) -> Column:
    """Distinct character bigrams of ``' ' + s + ' '`` as ints, rarest first.

    Normalised text only holds ``[a-z0-9 ]``. Each character is replaced by a byte
    that grows with its rarity, so that the hex form of two neighbours reads as a
    four-digit number: sorting in descending order then puts bigrams with a rare
    first character in front, the token order the similarity join wants, without
    a pass over the data. One regular expression cuts out the numbers, so no
    per-element lambda is involved. Empty text has no bigrams.
    """
    padded = F.concat(F.lit(" "), normalized, F.lit(" "))
    digits = F.hex(F.translate(padded, _BY_FREQUENCY, _STAND_INS[: len(_BY_FREQUENCY)]))
    pairs = F.regexp_extract_all(digits, F.lit("(?=([0-9]{4}))[0-9]{2}"), F.lit(1)).cast("array<int>")
    return F.when(normalized != "", F.sort_array(F.array_distinct(pairs), asc=False))


def dice(a: Column, b: Column) -> Column:
    """Set Dice of two bigram-code arrays; 0 if either is null (empty text)."""
    both = F.lit(2.0) * F.size(F.array_intersect(a, b)) / (F.size(a) + F.size(b))
    return F.when(a.isNotNull() & b.isNotNull(), both).otherwise(F.lit(0.0))


def dice_text(a: Column, b: Column) -> Column:
    return dice(bigram_codes(a), bigram_codes(b))


#: Words of a bigram set: one bit for each of 37 x 37 neighbours.
SET_WORDS = (len(_BY_FREQUENCY) ** 2 + 63) // 64


def bigram_number(code: Column) -> Column:
    """A bigram's code as a number from 0 to 37 * 37 - 1."""
    n = len(_BY_FREQUENCY)
    return F.floor(code / 100).cast("int") * n + code % 100 - 30 * n - 30


def bigram_numbers(codes: Column) -> Column:
    """The same bigrams as numbers."""
    return F.transform(codes, bigram_number)


def bigram_set(numbers: Column) -> Column:
    """Bigram numbers as an exact bit set: ``n`` of them in words ``b0`` to ``b21``. Null for null."""
    zero = F.lit(0).cast("bigint")

    def word(k: int) -> Column:
        bit = lambda x: F.call_function("shiftleft", F.lit(1).cast("bigint"), x % 64)
        return F.aggregate(F.filter(numbers, lambda x: F.floor(x / 64) == k), zero, lambda acc, x: acc.bitwiseOR(bit(x)))

    words = F.struct(F.size(numbers).alias("n"), *[word(k).alias(f"b{k}") for k in range(SET_WORDS)])
    return F.when(numbers.isNotNull(), words)


def folded_set(bits: Column) -> Column:
    """A set from ``bigram_set`` with its fold to two words, ``f0`` and ``f1``, added; ``spare`` bigrams share a folded bit with another one.

    Intersections of such sets are counted in generated code, without arrays.
    """
    f0, f1 = bits["b0"], bits["b1"]
    for k in range(2, SET_WORDS, 2):
        f0, f1 = f0.bitwiseOR(bits[f"b{k}"]), f1.bitwiseOR(bits[f"b{k + 1}"]) if k + 1 < SET_WORDS else f1
    spare = bits["n"] - F.bit_count(f0) - F.bit_count(f1)
    fields = [bits[f"b{k}"].alias(f"b{k}") for k in range(SET_WORDS)]
    return F.when(bits.isNotNull(), F.struct(bits["n"].alias("n"), f0.alias("f0"), f1.alias("f1"), spare.alias("spare"), *fields))


def shared_at_most(a: Column, b: Column) -> Column:
    """Upper bound of the common bigrams of two folded sets, from two words each."""
    common = F.bit_count(a["f0"].bitwiseAND(b["f0"])) + F.bit_count(a["f1"].bitwiseAND(b["f1"]))
    return common + F.least(a["spare"], b["spare"])


def shared_bigrams(a: Column, b: Column) -> Column:
    out = F.bit_count(a["b0"].bitwiseAND(b["b0"]))
    for k in range(1, SET_WORDS):
        out = out + F.bit_count(a[f"b{k}"].bitwiseAND(b[f"b{k}"]))
    return out


def dice_sets(a: Column, b: Column) -> Column:
    """Set Dice of two folded sets; 0 if either is null (empty text)."""
    return F.when(a.isNotNull() & b.isNotNull(), F.lit(2.0) * shared_bigrams(a, b) / (a["n"] + b["n"])).otherwise(F.lit(0.0))


def dice_at_most(a: Column, b: Column) -> Column:
    """Upper bound of ``dice_sets`` from the folds."""
    return F.when(a.isNotNull() & b.isNotNull(), F.lit(2.0) * shared_at_most(a, b) / (a["n"] + b["n"])).otherwise(F.lit(0.0))


# ------------------------------------------------------------------- numbers


def fixed4(x: Column) -> Column:
    """Round a non-negative double to four decimals by its exact binary value.

    ``round`` looks at the shortest decimal form and differs on ties such as
    0.74125. The product x * 10000 is formed exactly as p + e (a two-product with
    a split of x) and the tie is decided on that.
    """
    ten4 = F.lit(10000.0)
    p = x * ten4
    t = F.lit(134217729.0) * x
    hi = t - (t - x)
    e = (hi * ten4 - p) + (x - hi) * ten4
    up = F.when(((p - F.floor(p)) - 0.5) + e >= 0, 1.0).otherwise(0.0)
    return (F.floor(p) + up) / ten4


def number_or_null(c: Column) -> Column:
    """Text to double; null when it is not a plain decimal number, or is zero."""
    # A cast alone would also take Java's forms, such as 5d or 12F.
    plain = trim_ws(c).rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$")
    n = F.when(plain, trim_ws(c).try_cast("double"))
    return F.when((n != 0) & ~F.isnan(n), n)


# ------------------------------------------------------------ json and paths


def json_text(c: Column) -> Column:
    """Compact JSON text of a string, null for null."""
    # the quotes around the text keep its own brackets safe from the trimming
    return F.when(c.isNotNull(), F.btrim(F.to_json(F.array(c)), F.lit("[]")))


def json_number(c: Column) -> Column:
    """JSON text of a double; whole numbers carry no fraction."""
    whole = (c == F.floor(c)) & (F.abs(c) < 1e15)
    return F.when(whole, c.cast("bigint").cast("string")).otherwise(c.cast("string"))


def field_path_key(scope: Column, field: Column, contact_id: Column) -> Column:
    return F.when(scope == "contact", F.concat_ws(".", F.lit("contact"), contact_id, field)).otherwise(
        F.concat_ws(".", scope, field)
    )


def fingerprint(source_id: Column, record_id: Column, fields: dict[str, Column]) -> Column:
    """``source:record`` when the record has an id, else a hash over its stable fields."""
    parts = [F.concat(F.lit(f"{k}="), F.coalesce(v, F.lit(""))) for k, v in sorted(fields.items())]
    digest = F.sha2(F.concat_ws("|", source_id, *parts), 256)
    return F.when(truthy(record_id), F.concat(source_id, F.lit(":"), record_id)).otherwise(
        F.concat(source_id, F.lit(":hash-"), F.left(digest, F.lit(16)))
    )


def naics_bucket(code: Column, width: int) -> Column:
    code = string_field(code)
    return (
        F.when(code.isNull(), "(missing)")
        .when(F.length(code) >= width, F.left(code, F.lit(width)))
        .otherwise("(short)")
    )


def city_limits_bucket(c: Column) -> Column:
    first = F.upper(F.left(string_field(c), F.lit(1)))
    return F.when(first == "I", "inside").when(first == "O", "outside").otherwise("unknown")
