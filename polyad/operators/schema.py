"""Column selection, naming, typing and column contracts.

Everything here works on ``df.columns`` and ``df.schema``; no job is started
unless a function returns counts.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterable, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from polyad.functions.values import as_column, to_number

Selector = Callable[[Sequence[str]], list[str]]


# -- selectors ----------------------------------------------------------------


def starts_with(*prefixes: str) -> Selector:
    wanted = tuple(p.lower() for p in prefixes)
    return lambda names: [n for n in names if n.lower().startswith(wanted)]


def ends_with(*suffixes: str) -> Selector:
    wanted = tuple(s.lower() for s in suffixes)
    return lambda names: [n for n in names if n.lower().endswith(wanted)]


def contains(*parts: str) -> Selector:
    wanted = [p.lower() for p in parts]
    return lambda names: [n for n in names if any(p in n.lower() for p in wanted)]


def any_of(*wanted: str) -> Selector:
    """The listed names that exist, in the listed order."""
    return lambda names: [w for w in wanted if w in names]


def all_of(*wanted: str) -> Selector:
    def pick(names: Sequence[str]) -> list[str]:
        absent = [w for w in wanted if w not in names]
        if absent:
            raise ValueError(f"columns do not exist: {absent}")
        return list(wanted)

    return pick


def everything() -> Selector:
    return list


def resolve(df: DataFrame, *selectors: Selector | str) -> list[str]:
    """Names matched by the selectors, each once, in order of first match."""
    names: dict[str, None] = {}
    for selector in selectors:
        pick = all_of(selector) if isinstance(selector, str) else selector
        names.update(dict.fromkeys(pick(df.columns)))
    return list(names)


def keep(df: DataFrame, *selectors: Selector | str) -> DataFrame:
    return df.select(*[F.col(f"`{n}`") for n in resolve(df, *selectors)])


def drop(df: DataFrame, *selectors: Selector | str) -> DataFrame:
    gone = set(resolve(df, *[any_of(s) if isinstance(s, str) else s for s in selectors]))
    return df.select(*[F.col(f"`{n}`") for n in df.columns if n not in gone])


def across(df: DataFrame, columns: Iterable[str], fn: Callable[[Column], Column], name: str = "{}") -> DataFrame:
    """Apply one column function to many columns."""
    return df.withColumns({name.format(c): fn(as_column(c)) for c in columns})


# -- names --------------------------------------------------------------------


def rename_aliases(df: DataFrame, aliases: Mapping[str, Sequence[str]]) -> DataFrame:
    """Rename the first-class name's alias when present; absent aliases are skipped.

    Two candidates for one target would give two columns of the same name, so
    that case is an error.
    """
    renames: dict[str, str] = {}
    for target, old_names in aliases.items():
        present = [n for n in dict.fromkeys([target, *old_names]) if n in df.columns]
        if len(present) > 1:
            raise ValueError(f"{target!r} is claimed by several columns: {present}")
        if present and present[0] != target:
            renames[present[0]] = target
    return df.withColumnsRenamed(renames)


def suffix_columns(df: DataFrame, suffix: str, except_: Iterable[str] = ()) -> DataFrame:
    kept = set(except_)
    return df.select(*[as_column(c) if c in kept else as_column(c).alias(c + suffix) for c in df.columns])


def clean_name(name: str) -> str:
    """snake_case form of a column name (``COWcode`` becomes ``co_wcode``)."""
    text = name.replace("%", "_percent_").replace("#", "_number_").replace("'", "")
    text = unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode()
    text = re.sub(r"[^0-9A-Za-z]+", "_", text)
    text = re.sub(r"([A-Z]+)([A-Z][a-z])", r"\1_\2", text)
    text = re.sub(r"([a-z])([A-Z])", r"\1_\2", text)
    text = re.sub(r"_+", "_", text).strip("_").lower()
    return "x" + text if not text or text[0].isdigit() else text


def clean_name_map(names: Sequence[str]) -> list[tuple[str, str]]:
    """(original, clean) pairs; repeated clean names are numbered from 2."""
    seen: dict[str, int] = {}
    pairs = []
    for name in names:
        clean = clean_name(name)
        seen[clean] = seen.get(clean, 0) + 1
        pairs.append((name, clean if seen[clean] == 1 else f"{clean}_{seen[clean]}"))
    return pairs


def clean_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[clean for _, clean in clean_name_map(df.columns)])


def name_map_table(spark: SparkSession, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    return inline_table(spark, "original_tag string, clean_name string", pairs)


def inline_table(spark: SparkSession, schema: str, rows: Sequence[Sequence]) -> DataFrame:
    """A literal table that travels inside the plan, so the optimizer knows its size."""
    struct = T.StructType.fromDDL(schema)
    records = [dict(zip(struct.names, row, strict=True)) for row in rows]
    return spark.createDataFrame(pa.Table.from_pylist(records, schema=to_arrow_schema(struct)))


# -- types --------------------------------------------------------------------


def ensure_columns(df: DataFrame, wanted: Mapping[str, str]) -> DataFrame:
    """Add absent columns as typed NULLs."""
    absent = {n: F.lit(None).cast(t) for n, t in wanted.items() if n not in df.columns}
    return df.withColumns(absent) if absent else df


def rename_if_present(df: DataFrame, renames: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed({old: new for old, new in renames.items() if old in df.columns})


def column_or(df: DataFrame, name: str, fallback: Column | None = None) -> Column:
    """The column when it exists, else the fallback (typed NULL by default)."""
    if name in df.columns:
        return as_column(name)
    return F.lit(None).cast("double") if fallback is None else fallback


def as_category(df: DataFrame, columns: Iterable[str], fill_missing: str | None = None) -> DataFrame:
    """Turn columns into text categories and tag them in the schema metadata.

    Without ``fill_missing``, values become their text. With it, columns that are
    tagged already keep their labels; all others, text too, are parsed as numbers
    and truncated to integers, and what is missing or no number gets that label.
    """
    tagged = set(category_columns(df))
    new: dict[str, Column] = {}
    for name in columns:
        if name not in df.columns:
            continue
        if fill_missing is None:
            label = as_column(name).cast("string")
        elif name in tagged:
            label = F.coalesce(as_column(name), F.lit(fill_missing))
        else:
            label = F.coalesce(to_number(name).cast("bigint").cast("string"), F.lit(fill_missing))
        new[name] = label.alias(name, metadata={"kind": "category"})
    return df.select(*[new.get(c, F.col(c)) for c in df.columns])


def category_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if (f.metadata or {}).get("kind") == "category"]


def level_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(variable, level, n) over all listed columns in one shuffle."""
    present = [c for c in columns if c in df.columns]
    pairs = F.array(*[F.struct(F.lit(c).alias("variable"), F.col(c).cast("string").alias("level")) for c in present])
    return df.select(F.inline(pairs)).groupBy("variable", "level").agg(F.count("*").alias("n"))


def level_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per requested variable: was it found, and how many levels it has."""
    spark = df.sparkSession
    requested = inline_table(spark, "variable string, found boolean", [(c, c in df.columns) for c in columns])
    levels = level_counts(df, columns).groupBy("variable").agg(F.count("*").alias("levels"))
    return requested.join(levels, "variable", "left").select(
        "variable", "found", F.coalesce("levels", F.lit(0)).cast("bigint").alias("levels")
    )


# -- contracts ----------------------------------------------------------------


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    return [c for c in required if c not in df.columns]


def require_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    absent = missing_columns(df, required)
    if absent:
        raise ValueError(f"required columns are missing: {absent}")
    return df


def contract_report(
    df: DataFrame, contracts: Mapping[str, Sequence[str]], aliases: Mapping[str, Sequence[str]] | None = None
) -> DataFrame:
    """One row per required column: present before and after the alias rename, and its filled rows."""
    renamed = rename_aliases(df, aliases or {})
    rows = [(contract, column) for contract, columns in contracts.items() for column in columns]
    filled = renamed.agg(
        F.array(
            *[
                F.struct(
                    F.lit(contract).alias("contract"),
                    F.lit(column).alias("column_name"),
                    F.lit(column in df.columns).alias("present_before"),
                    F.lit(column in renamed.columns).alias("present_after"),
                    F.count(column_or(renamed, column)).alias("filled_rows"),
                )
                for contract, column in rows
            ]
        ).alias("report")
    )
    return filled.select(F.inline("report"))
