"""Names matched with a table of patterns.

Every pattern is indexed by a piece of text that a name must hold to match it, the
rarest one among the names: a required text of up to LONGEST characters, or a part
of a longer one. Names meet patterns by equality on 64 bits of these pieces; the
pattern itself is tested on such candidates only. Of a name's pieces, those that no
pattern wants are dropped in the scan by a filter of FILTER_BITS bits, and how many
names hold a piece is read from COUNTERS counters. Both are of fixed size and let a few too
many pass, which costs a test of a candidate and changes no result.

Patterns are Java regular expressions, tested case-sensitively unless they say
otherwise. NULL names, patterns and units take no part. A pattern of which no
required text can be told (``.*``, ``[a-z]+``, flags other than a leading
``(?i)``) is tested on every name, dealt to ``SLOTS`` groups. An invalid
pattern raises when it is tested.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from polyad.functions.values import as_column
from polyad.operators.crosswalk import override
from polyad.operators.joins import key_join
from polyad.session import stage

LONGEST = 16  # characters of a piece at most
FILTER_BITS = 1 << 24  # of the filter of wanted pieces; more pieces only make it less selective
COUNTERS = 1 << 22  # of the names that hold a piece; more names only make the choice of a piece less sharp
SLOTS = 64

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_CUT = "\u0001"


def _folded(text: Column) -> Column:
    """A-Z in lower case: what a case-insensitive pattern may confuse, no more."""
    return F.translate(text, _UPPER, _LOWER)


def _pieces(text: Column, length: int) -> Column:
    """All substrings of one length."""
    count = F.length(text) - (length - 1)
    none = F.array().cast("array<string>")
    return F.when(count > 0, F.transform(F.sequence(F.lit(1), count), lambda i: F.substr(text, i, F.lit(length)))).otherwise(none)


def required_texts(regex: Column) -> Column:
    """For each top-level alternative, the folded texts that a match of it must hold; none if that is not certain."""
    bare = F.regexp_replace(regex, r"^\(\?i\)", "")
    unread = bare.rlike(r"\\[A-Za-z0-9&&[^dDwWsSbBAzZG]]|\(\?[^:=!<]")
    # Escapes, then classes, then groups from the inside, then what is optional or counted.
    for part in (r"(?s)\\.", r"\[[^\]]*\]", *[r"\([^()]*\)"] * 6, r"(?s).[?*]+", r"(?s).\{[^}]*\}"):
        bare = F.regexp_replace(bare, part, _CUT)
    unread = unread | bare.rlike(r"[\[\](){}]")
    branches = F.split(_folded(bare), r"\|", -1)
    texts = F.transform(branches, lambda b: F.filter(F.split(b, f"[{_CUT}.^$+]"), lambda t: F.length(t) > 0))
    return F.when(unread, F.array(F.array().cast("array<string>"))).otherwise(texts)


def _longest_pieces(text: Column) -> Column:
    """The text itself, or all its pieces of the greatest indexed length."""
    return F.when(F.length(text) > LONGEST, _pieces(text, LONGEST)).otherwise(F.array(text))


def _held(names: DataFrame, wanted: DataFrame) -> DataFrame:
    """(name, piece): the wanted pieces that names hold, and a few others that the filter lets pass.

    The filter has a row for each 64 of its bits, so it is small enough to reach the names wherever they are.
    """
    wanted = wanted.where("piece IS NOT NULL")
    lengths = sorted(r.length for r in wanted.select("length").distinct().collect())  # LONGEST numbers at most
    bit = F.pmod("piece", F.lit(FILTER_BITS))
    words = wanted.select(bit.alias("bit")).groupBy(F.expr("bit div 64").alias("word"))
    words = stage(words.agg(F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 AS int))")).alias("bits")), "filter")
    none = F.array().cast("array<string>")
    pieces = F.transform(F.concat(none, *[_pieces(F.col("folded"), k) for k in lengths]), lambda x: F.xxhash64(x))
    held = names.select("name", _folded(F.col("name")).alias("folded")).select("name", F.explode(F.array_distinct(pieces)).alias("piece")).select("name", "piece", bit.alias("bit"))
    return held.withColumn("word", F.expr("bit div 64")).join(words, "word").where("getbit(bits, cast(bit % 64 AS int)) = 1").select("name", "piece")


def _index(patterns: DataFrame, names: DataFrame) -> DataFrame:
    """(piece, length, slot, pattern, unit): the rarest required piece of each alternative, if any name holds it."""
    branches = patterns.select("pattern", "unit", F.posexplode(required_texts(F.col("pattern"))).alias("branch", "texts"))
    texts = branches.select(
        "pattern", "unit", "branch", F.explode_outer(F.array_distinct(F.flatten(F.transform("texts", _longest_pieces)))).alias("text")
    )
    hashed = F.when(F.col("text").isNotNull(), F.xxhash64("text"))
    pieces = stage(texts.select("pattern", "unit", "branch", hashed.alias("piece"), F.length("text").alias("length")), "pieces")
    place = F.pmod("piece", F.lit(COUNTERS)).alias("place")
    counts = _held(names, pieces).groupBy(place).agg(F.count("*").alias("n"))
    rated = pieces.where("piece IS NOT NULL").withColumn("place", place).join(counts, "place", "left")
    best = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "piece", "length")).alias("best")
    rarest = rated.groupBy("pattern", "unit", "branch").agg(best).where("best.n > 0")
    keyed = rarest.select("best.piece", "best.length", F.lit(-1).alias("slot"), "pattern", "unit")
    slots = F.explode(F.sequence(F.lit(0), F.lit(SLOTS - 1))).alias("slot")
    return keyed.unionByName(pieces.where("piece IS NULL").select("piece", "length", slots, "pattern", "unit"))


def match_name_table(
    df: DataFrame,
    name: str,
    patterns: DataFrame,
    overrides: Mapping[str, int | None] | None = None,
    pattern: str = "pattern",
    unit: str = "unit",
) -> DataFrame:
    """One row per distinct name: (name, unit, n_matches, status), as :func:`match_names`, for any number of patterns."""
    rows = patterns.select(as_column(pattern).alias("pattern"), as_column(unit).alias("unit")).dropna().distinct()
    dtype = rows.schema["unit"].dataType.simpleString()
    names = stage(df.select(as_column(name).alias("name")).where("name IS NOT NULL").distinct(), "names")
    index = stage(_index(rows, names), "patterns")
    # Patterns without a certain text meet all names of their slot, under a piece of their own.
    key = F.coalesce("piece", F.lit(0)).alias("piece")
    places = _held(names, index).select("name", "piece", F.lit(-1).alias("slot")).unionByName(
        names.select("name", F.lit(0).cast("long").alias("piece"), F.pmod(F.hash("name"), F.lit(SLOTS)).alias("slot"))
    )
    met = places.join(index.select(key, "slot", "pattern", "unit"), ["piece", "slot"]).where(F.rlike("name", "pattern"))
    # Several patterns, and several alternatives of one, may say the same unit.
    hits = met.select("name", "unit").distinct().groupBy("name").agg(F.count("*").alias("n"), F.min("unit").alias("only"))
    known = list(overrides or {})
    overridden = F.col("name").isin(known) if known else F.lit(False)
    n = F.coalesce("n", F.lit(0)).cast("int")
    return names.join(hits, "name", "left").select(
        F.col("name").alias(name),
        override(F.col("name"), overrides or {}, F.when(n == 1, F.col("only")), dtype).alias("unit"),
        n.alias("n_matches"),
        F.when(overridden, "override")
        .when(n == 0, "unmatched")
        .when(n > 1, "ambiguous")
        .otherwise("matched")
        .alias("status"),
    )


def map_name_table(
    df: DataFrame,
    name: str,
    patterns: DataFrame,
    overrides: Mapping[str, int | None] | None = None,
    into: str = "unit",
    pattern: str = "pattern",
    unit: str = "unit",
) -> DataFrame:
    """Attach the unit found by :func:`match_name_table` to every row."""
    found = stage(match_name_table(df, name, patterns, overrides, pattern, unit).select(as_column(name).alias("__name"), "unit"), "names")
    return key_join(df, found.withColumnRenamed("unit", into), {name: "__name"}, "left", null_safe=False)
