"""Secret scans with corpus-wide ownership frequency, in DataFrame functions only.

Patterns find candidates in every text. Each candidate's value is hashed, and the
hashes are aggregated by distinct repository and owner over the whole corpus. A
value that more than ``most_owners`` owners publish, or that stands in more than
``most_repositories`` repositories, is an example that was copied widely; one that
stays with its owners and looks random is a live credential. The
base kinds are always reported; candidates of the further kinds are reported if
they are live. Values are hashed and judged in the scan of the texts: no plain value
is written to a stage table or sent through a shuffle.

A private key's span is its whole block, from the header to the END line, or without
one to the end of the base64 lines, and its value is the key: what the header says is
the same for all keys of a type. A header without a key is its own value.

Offsets count code points, ends are exclusive. Matches of a kind are leftmost and
do not overlap; spans of different kinds may.

Edge cases: NULL text counts as empty and has no span. A NULL owner or repository
counts as one of its own. Rows that repeat are reported each. Columns beyond
``doc_id``, ``text`` and those named as owner and repository are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from polyad.session import stage, stages

# kind: (pattern, group of the value, least length of the value); the first three are the base kinds
KINDS = {
    "assign": (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    "access": (r"AKIA[A-Z0-9]{16,}", 0, 20),
    "hex": (r"[0-9a-f]{24,}", 0, 24),
    "prefixed": (r"(?:gh[oprsu]_[A-Za-z0-9]{20,}|sk[-_][A-Za-z0-9_-]{16,}|xox[abprs]-[A-Za-z0-9-]{10,}|AIza[A-Za-z0-9_-]{30,}|eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]*)", 0, 14),
    "login": (r"://[^\s:/@]{1,64}:([^\s:/@]{1,64})@", 1, 6),
    "block": (r"-----BEGIN [A-Z ]{0,32}PRIVATE KEY-----", 0, 1),
    "opaque": (r"[A-Za-z0-9+/_-]{24,}", 0, 24),
}
# of a block: group 1 is what follows the header, up to the next line of dashes if that is the END, or else lines of base64
_FOUND = "array<struct<kind:int, start:int, stop:int, hash:string, random:boolean>>"
_GAP, _LINE = r"(?:\s|\\[nr])", r"[A-Za-z0-9+/=]"
BLOCK = (
    KINDS["block"][0]
    + r"((?:[^-]++|-(?!----))*+(?=-----END [A-Z ]{0,32}PRIVATE KEY-----)"
    + rf"|(?:(?:{_GAP}++(?:Proc-Type|DEK-Info|Version|Comment): [^\r\n]*+)*+(?:{_GAP}*+{_LINE}{{16,}}+)++(?:{_GAP}++{_LINE}{{1,15}}+(?=[ \t]*+(?:[\r\n]|\\[nr]|\z)))?+)?+)"
    + r"(?:-----END [A-Z ]{0,32}PRIVATE KEY-----)?+"
)
BASE = ("assign", "access", "hex")
MOST_OWNERS = 2
MOST_REPOSITORIES = 5
ORDER = {kind: i for i, kind in enumerate(KINDS)}
PLACEHOLDER = r"(?i)example|sample|placeholder|change.?me|your.?(key|token|secret)|x{6}|\*{4}|123456|abcdef"


def _spans(text: Column, kind: str) -> Column:
    """Matches of one kind in order: structs of kind number, start, end, the value's hash, and whether it looks random.

    Splitting a text at its matches gives the gaps between them, so starts are sums of lengths.
    """
    pattern, group, least = KINDS[kind]
    if kind == "block":
        pattern, group = BLOCK, 1
    whole, value = (F.regexp_extract_all(text, F.lit(pattern), F.lit(g)) for g in (0, group))
    if kind == "block":
        value = F.zip_with(value, whole, _key)
    found = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), whole.alias("whole"), value.alias("value"))
    empty = F.expr(f"cast(array() AS {_FOUND})")

    def add(state: Column, x: Column) -> Column:
        start = state["at"] + F.length(x["gap"])
        stop = start + F.coalesce(F.length(x["whole"]), F.lit(0))
        row = F.struct(F.lit(ORDER[kind]).alias("kind"), start.alias("start"), stop.alias("stop"), F.sha2(x["value"], 256).alias("hash"), _random(x["value"]).alias("random"))
        good = F.coalesce(F.length(x["value"]) >= least, F.lit(False))
        return F.struct(stop.alias("at"), F.when(good, F.concat(state["out"], F.array(row))).otherwise(state["out"]).alias("out"))

    return F.aggregate(found, F.struct(F.lit(0).alias("at"), empty.alias("out")), add, lambda s: s["out"])


def _key(body: Column, whole: Column) -> Column:
    """A block's key without line ends, quotes and the like, so that its layout does not matter."""
    bare = F.regexp_replace(body, r"\\[nr]|[^A-Za-z0-9+/=]", "")
    return F.when(F.length(bare) > 0, bare).otherwise(whole)


def candidates(docs: DataFrame, owner: Column, repository: Column) -> DataFrame:
    """(key, doc_id, print, owner, repository, found): every row with its spans of all kinds; a single pattern rules out most texts first."""
    text = F.coalesce("text", F.lit(""))
    any_kind = "|".join(f"(?:{pattern})" for pattern, _, _ in KINDS.values())
    docs = docs.select(F.monotonically_increasing_id().alias("key"), "doc_id", F.xxhash64(text).alias("print"), owner.cast("string").alias("owner"), repository.cast("string").alias("repository"), text.alias("text"))
    found = F.flatten(F.array(*(_spans(F.col("text"), kind) for kind in KINDS)))
    none = F.expr(f"cast(array() AS {_FOUND})")
    return docs.select("key", "doc_id", "print", "owner", "repository", F.when(F.col("text").rlike(any_kind), found).otherwise(none).alias("found"))


def _random(value: Column) -> Column:
    """Ten different characters or more, more than one class of them, and no placeholder."""
    classes = sum(value.rlike(p).cast("int") for p in ("[a-z]", "[A-Z]", "[0-9]"))
    return (F.size(F.array_distinct(F.split(value, ""))) >= 10) & (classes >= 2) & ~value.rlike(PLACEHOLDER)


def scan(docs: DataFrame, owner: Column, repository: Column, most_owners: int = MOST_OWNERS, most_repositories: int = MOST_REPOSITORIES) -> tuple[DataFrame, DataFrame]:
    """All rows (key, doc_id, print), and their spans (key, kind, start, stop, owners, repositories, live, reported).

    Counts are reduced by (hash, owner, repository) in the map tasks, so a value in a third of all rows is a few rows.
    """
    held = stage(candidates(docs, owner, repository), "candidates")
    rows = held.select("key", "owner", "repository", F.explode("found").alias("x")).select("key", "owner", "repository", "x.*")
    places = rows.groupBy("hash", "owner", "repository").agg(F.count("*").alias("times"))
    owned = places.groupBy("hash", "owner").agg(F.count("*").alias("repositories"), F.sum("times").alias("times"))
    spread = stage(owned.groupBy("hash").agg(F.count("*").alias("owners"), F.sum("repositories").alias("repositories"), F.sum("times").alias("times")), "spread")
    joined = rows.join(spread, "hash")
    base = F.col("kind").isin([ORDER[k] for k in BASE])
    always = F.col("kind").isin([ORDER["block"], ORDER["prefixed"], ORDER["login"]])
    live = (F.col("owners") <= most_owners) & (F.col("repositories") <= most_repositories) & (F.col("random") | always)
    spans = joined.withColumn("live", live).withColumn("reported", base | F.col("live"))
    return held.select("key", "doc_id", "print"), spans.select("key", "kind", "start", "stop", "owners", "repositories", "times", "live", "reported")


def digest(docs: DataFrame, owner: Column, repository: Column) -> DataFrame:
    """One row per row of ``docs``: counts of the base kinds, a hash of the base spans, all reported spans, how many are live,
    and the most owners and repositories that one of the reported values has (0 without one).

    Spans of the further kinds are left out where a span of a kind listed before covers them.
    """
    rows, spans = scan(docs, owner, repository)
    kinds = F.array(*(F.lit(k) for k in KINDS))
    listed = spans.where("reported").groupBy("key").agg(F.sort_array(F.collect_list(F.struct("start", "kind", "stop", "live", "owners", "repositories"))).alias("found"))

    def joined(found: Column) -> Column:
        return F.array_join(F.transform(found, lambda x: F.concat_ws(":", F.element_at(kinds, x["kind"] + 1), x["start"], x["stop"])), ",")

    every = F.coalesce("found", F.expr("cast(array() AS array<struct<start:int, kind:int, stop:int, live:boolean, owners:bigint, repositories:bigint>>)"))
    base = F.filter(every, lambda x: x["kind"] < len(BASE))
    found = F.filter(every, lambda x: (x["kind"] < len(BASE)) | ~F.exists(every, lambda b: (b["kind"] < x["kind"]) & (b["start"] <= x["start"]) & (x["stop"] <= b["stop"])))
    count = lambda kind: F.size(F.filter(found, lambda x: x["kind"] == ORDER[kind])).cast("long").alias(f"n_{kind}")
    return rows.join(listed, "key", "left").select(
        "doc_id", *(count(k) for k in BASE), F.sha2(joined(base), 256).alias("base_sha256"), joined(found).alias("spans"),
        F.size(F.filter(found, lambda x: x["live"])).cast("long").alias("n_live"),
        *(F.coalesce(F.array_max(F.transform(found, lambda x: x[c])), F.lit(0)).cast("long").alias(f"most_{c}") for c in ("owners", "repositories")),
    )


def redacted(text: Column, found: Column, mark: str = "[SECRET]") -> Column:
    """``text`` with every span of ``found`` (structs with start and stop, in order) replaced; overlapping spans become one mark."""

    def step(state: Column, x: Column) -> Column:
        fresh = F.concat(state["out"], F.substring(text, state["at"] + 1, x["start"] - state["at"]), F.lit(mark))
        return F.struct(F.greatest(state["at"], x["stop"]).alias("at"), F.when(x["start"] >= state["at"], fresh).otherwise(state["out"]).alias("out"))

    done = lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text)))
    return F.aggregate(found, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step, done)


def hide(docs: DataFrame, owner: Column, repository: Column, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every reported span replaced in ``text``, and ``n_chars``, if there is such a column, counted anew.

    Spans go back to the rows by doc_id and a hash of the text, so rows may repeat. NULL texts stay NULL.
    """
    own = "_secrets_"
    with stages(docs.sparkSession) as inside:
        rows, spans = scan(docs, owner, repository)
        listed = spans.where("reported").groupBy("key").agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("found"))
        marks = rows.join(listed, "key").groupBy("doc_id", "print").agg(F.first("found").alias("found"))
        marks = inside.keep(marks.select(*(F.col(c).alias(own + c) for c in ("doc_id", "print", "found"))), "marks")
    same = F.col("doc_id").eqNullSafe(F.col(own + "doc_id")) & (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col(own + "print"))
    joined = docs.join(marks, same, "left")
    text = F.when(F.col(own + "found").isNull(), F.col("text")).otherwise(redacted(F.col("text"), F.col(own + "found"), mark))
    new = joined.withColumn(own + "text", text)
    changed = {"text": F.col(own + "text")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col(own + "found").isNull(), F.col("n_chars")).otherwise(F.length(own + "text")).cast(docs.schema["n_chars"].dataType)
    return new.select(*(changed[c].alias(c) if c in changed else F.col(f"`{c}`") for c in docs.columns))
