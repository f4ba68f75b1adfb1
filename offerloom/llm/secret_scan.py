"""Secret scan with DataFrame functions only.

Three base kinds are regular expressions. The fourth looks at candidate strings of secret-like characters: a window
slides over each string, and its Shannon entropy follows from the counts of the character that enters and the one that
leaves. Windows above the bound of their character class are merged into spans; strings on the allow-list, and
spans that a base kind has reported, are suppressed.
"""

from __future__ import annotations

from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed patterns of the base kinds.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 12, 18, 16
KINDS = ("assign", "access", "hex", "entropy")

CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
WINDOW = 20
PIECE = 256
#: Bits per character from which a window is suspicious: hexadecimal digits, letters and digits, any candidate characters.
HEX_BITS, PLAIN_BITS, ANY_BITS = 3.0, 3.7, 3.9
#: Strings that are known not to be secrets.
ALLOWED = r"(?i)example|sample|placeholder|dummy|changeme|x{6,}|lorem|^[a-z]+([_/-][a-z0-9]{1,12})+$|^[0-9]+([_/-][0-9]+)*$|^[A-Za-z_/=+-]+$"

SPAN = "struct<start:int,kind:int,end:int>"
NO_SPANS = f"array<{SPAN}>"


def _pieces(values: Column) -> Column:
    """An array in pieces of PIECE elements: what appends to a list copies it, so lists are kept short."""
    last = F.floor((F.greatest(F.size(values), F.lit(1)) - 1) / PIECE).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(values, k * PIECE + 1, PIECE))


def _spans(text: Column, pattern: str, kind: int) -> Column:
    """Code-point spans of all matches of the pattern, in order: what lies between matches is what splitting leaves."""
    between, found = F.split(text, pattern), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    lengths = F.arrays_zip(F.transform(between, F.length).alias("gap"), F.transform(found, F.length).alias("match"))

    def total(acc: Column, x: Column) -> Column:
        return acc + x["gap"] + F.coalesce(x["match"], F.lit(0))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + x["gap"]
        end = begin + F.coalesce(x["match"], F.lit(0))
        span = F.struct(begin.alias("start"), F.lit(kind).alias("kind"), end.alias("end"))
        return F.struct(end.alias("at"), F.when(x["match"].isNull(), acc["spans"]).otherwise(F.concat(acc["spans"], F.array(span))).alias("spans"))

    def located(pieces: Column) -> Column:
        """Where each piece begins, then the spans inside it."""
        sizes = F.transform(pieces, lambda p: F.aggregate(p, F.lit(0), total))
        begins = F.aggregate(sizes, F.array(F.lit(0)), lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n)))
        none = F.array().cast(NO_SPANS)
        return F.flatten(F.transform(F.arrays_zip(pieces.alias("piece"), begins.alias("at")), lambda x: F.when(x["piece"].isNull(), none).otherwise(
            F.aggregate(x["piece"], F.struct(x["at"].alias("at"), none.alias("spans")), step, lambda acc: acc["spans"]))))

    # one-element arrays bind what is used several times
    return F.transform(F.array(F.transform(F.array(lengths), _pieces)[0]), located)[0]


def _apart(hot: Column, base: Column) -> Column:
    """The spans of ``hot`` that overlap none of ``base``; pieces of the base are skipped by their bounds."""
    bounded = F.transform(_pieces(base), lambda p: F.struct(
        F.array_min(F.transform(p, lambda s: s["start"])).alias("low"), F.array_max(F.transform(p, lambda s: s["end"])).alias("high"), p.alias("spans")))
    return F.transform(F.array(bounded), lambda pieces: F.filter(hot, lambda h: ~F.exists(pieces, lambda p: F.coalesce(
        (p["low"] < h["end"]) & (h["start"] < p["high"]), F.lit(False)) & F.exists(p["spans"], lambda b: (b["start"] < h["end"]) & (h["start"] < b["end"])))))[0]


def _long_enough(text: Column, pattern: str, kind: int, least: int, group: int = 0) -> Column:
    spans = _spans(text, pattern, kind)
    if not group:
        return F.filter(spans, lambda s: s["end"] - s["start"] >= least)
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    both = F.filter(F.arrays_zip(spans.alias("span"), values.alias("value")), lambda b: F.length(b["value"]) >= least)
    return F.transform(both, lambda b: b["span"])


def _weight(count: Column) -> Column:
    return F.when(count > 1, count * F.log2(count.cast("double"))).otherwise(0.0)


def _hot_parts(string: Column, begin: Column) -> Column:
    """Spans of the windows of one string whose entropy is above the bound of their class.

    With counts c of W characters the entropy is log2 W - sum(c log2 c) / W; only two terms change per step.
    The class is that of the window's own characters, which follows from the last place of each kind of character. A
    window without a digit, or of 0-9 and a-f alone (the base kind ``hex`` has reported its run), has the string's class.
    """
    def bits(hexadecimal: Column, plain: Column) -> Column:
        return F.when(hexadecimal, HEX_BITS).when(plain, PLAIN_BITS).otherwise(ANY_BITS)

    whole = bits(F.rlike(string, F.lit("^[0-9a-fA-F]+$")), F.rlike(string, F.lit("^[A-Za-z0-9]+$")))

    def scan(chars: Column) -> Column:
        def count(window: Column, char: Column) -> Column:
            return F.size(window) - F.size(F.array_remove(window, char))

        def step(acc: Column, i: Column) -> Column:
            before = F.slice(chars, F.greatest(i - WINDOW, F.lit(0)) + 1, F.least(i, F.lit(WINDOW)))
            middle = F.slice(chars, F.greatest(i - WINDOW + 1, F.lit(0)) + 1, F.least(i, F.lit(WINDOW - 1)))
            left, entered = count(before, F.get(chars, i - WINDOW)), count(middle, F.get(chars, i))
            total = acc["total"] + _weight(entered + 1) - _weight(entered) + F.when(i >= WINDOW, _weight(left - 1) - _weight(left)).otherwise(0.0)
            char, low = F.get(chars, i), i - WINDOW + 1
            digit = char.between("0", "9")
            lower_hex = digit | char.between("a", "f")
            seen = {"digit": digit, "above": ~lower_hex, "letter": ~lower_hex & ~char.between("A", "F"), "sign": char.isin(*"+/_=-")}
            at = {k: F.when(now, i).otherwise(acc[k]) for k, now in seen.items()}
            own = (at["digit"] >= low) & (at["above"] >= low)
            bound = F.when(own, bits(at["letter"] < low, at["sign"] < low)).otherwise(whole)
            hot = (i >= WINDOW - 1) & (F.round(log2(WINDOW) - total / WINDOW, 6) >= bound)
            first = begin + i - WINDOW + 1
            last = F.element_at(acc["spans"], -1)
            joins = (F.size(acc["spans"]) > 0) & (last["end"] >= first)
            span = F.struct(F.when(joins, last["start"]).otherwise(first).cast("int").alias("start"), F.lit(3).alias("kind"), (begin + i + 1).cast("int").alias("end"))
            grown = F.concat(F.when(joins, F.slice(acc["spans"], 1, F.size(acc["spans"]) - 1)).otherwise(acc["spans"]), F.array(span))
            return F.struct(total.alias("total"), *[v.alias(k) for k, v in at.items()], F.when(hot, grown).otherwise(acc["spans"]).alias("spans"))

        start = F.struct(F.lit(0.0).alias("total"), *[F.lit(-1).alias(k) for k in ("digit", "above", "letter", "sign")], F.array().cast(NO_SPANS).alias("spans"))
        return F.aggregate(F.sequence(F.lit(0), F.size(chars) - 1), start, step, lambda acc: acc["spans"])

    return F.transform(F.array(F.split(string, "")), scan)[0]


def scanned(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``base`` and ``spans`` (arrays of start, kind number, end; code points, end exclusive) to the rows.

    A null text is empty and has none; repeated rows and other columns pass unchanged, columns of these names are
    replaced; an empty table stays empty. No shuffle.
    """
    raw = F.coalesce(F.col(text), F.lit(""))
    small = F.lower(raw)
    none = F.array().cast(NO_SPANS)
    hinted = F.contains(small, F.lit("passw")) | F.contains(small, F.lit("secret")) | F.contains(small, F.lit("token")) | F.contains(small, F.lit("api"))
    assign = F.when(hinted, _long_enough(raw, ASSIGN, 0, ASSIGN_LEAST, 2)).otherwise(none)
    access = F.when(F.contains(raw, F.lit("AKIA")), _long_enough(raw, ACCESS, 1, ACCESS_LEAST)).otherwise(none)
    # a run of 16 characters is where the greedy run of 16 or more begins
    long_hex = HEX.replace("+", f"{{{HEX_LEAST},}}")
    hexes = F.when(F.rlike(raw, F.lit(long_hex)), _spans(raw, long_hex, 2)).otherwise(none)
    based = docs.withColumn("base", F.array_sort(F.concat(assign, access, hexes)))

    strings = F.regexp_extract_all(raw, F.lit(CANDIDATE), F.lit(0))
    suspect = lambda s: F.rlike(s, F.lit("[0-9]")) & ~F.rlike(s, F.lit(ALLOWED))
    pairs = F.filter(F.arrays_zip(_spans(raw, CANDIDATE, 3).alias("span"), strings.alias("string")), lambda p: suspect(p["string"]))
    parts = F.flatten(F.transform(pairs, lambda p: _hot_parts(p["string"], p["span"]["start"])))
    hot = F.when(F.exists(strings, suspect), parts).otherwise(none)
    return based.withColumn("spans", F.array_sort(F.concat("base", _apart(hot, F.col("base")))))


def _listed(spans: str) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_digest(docs: DataFrame) -> DataFrame:
    found = scanned(docs.select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(KINDS[:3])],
                        F.sha2(_listed("base").cast("binary"), 256).alias("base_sha256"), _listed("spans").alias("spans"))
