"""Declarative data-quality rules compiled into one aggregate pass.

A suite is a named list of rules in the expectation-suite JSON shape
(``expectation_type`` + ``kwargs``). ``run_suite`` turns every row-level rule
into a ``count_if`` and evaluates all of them in a single ``agg`` (partial
aggregation per task, one tiny row to the driver). Key-uniqueness rules are
counted in the same scan, all of them in one grouping by (rule, key). Results are rows
(suite, rule, column_name, element_count, unexpected_count, success).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stormmart.functions.hashing import encode_values
from stormmart.schemas import QUALITY_RESULT_SCHEMA
from stormmart.session import shared_path

NOT_NULL = "expect_column_values_to_not_be_null"
BE_NULL = "expect_column_values_to_be_null"
IN_SET = "expect_column_distinct_values_to_be_in_set"
BETWEEN = "expect_column_values_to_be_between"
LENGTH_BETWEEN = "expect_column_value_lengths_to_be_between"
UNIQUE = "expect_column_values_to_be_unique"
COMPOUND_UNIQUE = "expect_compound_columns_to_be_unique"
# Short names of the model tests.
ALIASES = {"not_null": NOT_NULL, "unique": UNIQUE}

# Settings of a rule, besides its columns.
_RANGE = {"min_value", "max_value"}
RULE_KWARGS = {
    NOT_NULL: set(), BE_NULL: set(), IN_SET: {"value_set", "value_table", "value_column", "ignore_case"},
    BETWEEN: _RANGE | {"strict_min", "strict_max"}, LENGTH_BETWEEN: _RANGE,
    UNIQUE: set(), COMPOUND_UNIQUE: set(),
}

# --- fixed values: state names accepted by the source suite (compared in upper case).
STATE_NAMES = [
    "ALABAMA", "ALASKA", "ARIZONA", "ARKANSAS", "CALIFORNIA",
    "COLORADO", "CONNECTICUT", "DELAWARE", "DISTRICT OF COLUMBIA", "FLORIDA",
    "GEORGIA", "HAWAII", "IDAHO", "ILLINOIS", "INDIANA", "IOWA", "KANSAS",
    "KENTUCKY", "LOUISIANA", "MAINE", "MARYLAND", "MASSACHUSETTS",
    "MICHIGAN", "MINNESOTA", "MISSISSIPPI", "MISSOURI", "MONTANA", "NEBRASKA",
    "NEVADA", "NEW HAMPSHIRE", "NEW JERSEY", "NEW MEXICO", "NEW YORK",
    "NORTH CAROLINA", "NORTH DAKOTA", "OHIO", "OKLAHOMA", "OREGON",
    "PENNSYLVANIA", "PUERTO RICO", "RHODE ISLAND", "SOUTH CAROLINA",
    "SOUTH DAKOTA", "TENNESSEE", "TEXAS", "UTAH", "VERMONT", "VIRGINIA",
    "WASHINGTON", "WEST VIRGINIA", "WISCONSIN", "WYOMING",
]
# Columns that must be present in every source row.
REQUIRED_SOURCE_COLUMNS = ["begin_yearmonth", "begin_time", "begin_day", "state", "cz_name"]
# --- end of fixed values


class QualityGateError(RuntimeError):
    """Raised when a batch fails its suite; nothing of the batch is written."""


@dataclass(frozen=True)
class Rule:
    kind: str
    column: str | tuple[str, ...]
    kwargs: dict = field(default_factory=dict, hash=False, compare=False)

    def __post_init__(self) -> None:
        if self.kind not in RULE_KWARGS:
            raise ValueError(f"unknown rule {self.kind}")
        extra = set(self.kwargs) - RULE_KWARGS[self.kind] - {"mostly"}
        if extra:
            raise ValueError(f"{self.kind}: settings {sorted(extra)} are not known")
        if not 0 < self.mostly <= 1 or (self.mostly < 1 and self.kind in (UNIQUE, COMPOUND_UNIQUE)):
            raise ValueError(f"{self.kind}: mostly={self.mostly} is not possible")
        if self.kind == IN_SET and ("value_set" in self.kwargs) == ("value_table" in self.kwargs):
            raise ValueError(f"{self.kind}: either value_set or value_table names the values")

    @property
    def mostly(self) -> float:
        """Least share of the rule's values (all rows, or for rules on values those
        that are not null) that must meet it."""
        return float(self.kwargs.get("mostly", 1.0))

    @property
    def column_name(self) -> str:
        return ",".join(self.column) if isinstance(self.column, tuple) else self.column


@dataclass
class Suite:
    name: str
    rules: list[Rule]

    # -- JSON in the expectation-suite shape --------------------------------
    def to_json(self) -> str:
        exps = []
        for r in self.rules:
            kw = dict(r.kwargs)
            if isinstance(r.column, tuple):
                kw["column_list"] = list(r.column)
            else:
                kw["column"] = r.column
            exps.append({"expectation_type": r.kind, "kwargs": kw, "meta": {}})
        return json.dumps({"expectation_suite_name": self.name, "expectations": exps}, indent=2)

    @classmethod
    def from_json(cls, text: str) -> "Suite":
        doc = json.loads(text)
        rules = []
        for e in doc.get("expectations", []):
            kw = dict(e.get("kwargs", {}))
            col = kw.pop("column", None)
            cols = kw.pop("column_list", None)
            kind = ALIASES.get(e["expectation_type"], e["expectation_type"])
            rules.append(Rule(kind, tuple(cols) if cols else col, kw))
        return cls(doc.get("expectation_suite_name", "suite"), rules)

    def save(self, path: str) -> None:
        """Write the suite to a file of any file system that Spark reads."""
        spark = SparkSession.getActiveSession()
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        out = fs.create(target, True)
        out.write(bytearray(self.to_json().encode("utf-8")))
        out.close()

    @classmethod
    def load(cls, path: str) -> "Suite":
        spark = SparkSession.getActiveSession()
        return cls.from_json(spark.read.text(path, wholetext=True).first()[0])


# -- rule constructors -------------------------------------------------------
def not_null(column: str) -> Rule:
    return Rule(NOT_NULL, column)


def be_null(column: str) -> Rule:
    return Rule(BE_NULL, column)


def in_set(column: str, values: Iterable[str], ignore_case: bool = False) -> Rule:
    return Rule(IN_SET, column, {"value_set": list(values), "ignore_case": ignore_case})


def in_table(column: str, table: str, value_column: str, ignore_case: bool = False) -> Rule:
    """The set is a column of a table or view: any number of values."""
    return Rule(IN_SET, column, {"value_table": table, "value_column": value_column, "ignore_case": ignore_case})


def between(column: str, min_value=None, max_value=None,
            strict_min: bool = False, strict_max: bool = False) -> Rule:
    return Rule(BETWEEN, column, {"min_value": min_value, "max_value": max_value,
                                  "strict_min": strict_min, "strict_max": strict_max})


def length_between(column: str, min_value: int | None = None, max_value: int | None = None) -> Rule:
    return Rule(LENGTH_BETWEEN, column, {"min_value": min_value, "max_value": max_value})


def unique(*columns: str) -> Rule:
    return Rule(COMPOUND_UNIQUE, tuple(columns)) if len(columns) > 1 else Rule(UNIQUE, columns[0])


def source_suite(name: str = "event_source_suite") -> Suite:
    """Default gate for cleaned source rows (column names in lower case)."""
    rules = [not_null(c) for c in REQUIRED_SOURCE_COLUMNS]
    rules.append(in_set("state", STATE_NAMES, ignore_case=True))
    return Suite(name, rules)


def length_suite(limits: dict[str, int], name: str = "length_limits") -> Suite:
    """varchar(n) limits as rules: one bad row is reported, not fatal."""
    return Suite(name, [length_between(c, None, n) for c, n in limits.items()])


# -- compilation ----------------------------------------------------------------
def _range_violation(c: Column, lo, hi, strict_lo: bool, strict_hi: bool) -> Column:
    bad = F.lit(False)
    if lo is not None:
        bad = bad | ((c <= F.lit(lo)) if strict_lo else (c < F.lit(lo)))
    if hi is not None:
        bad = bad | ((c >= F.lit(hi)) if strict_hi else (c > F.lit(hi)))
    return c.isNotNull() & bad


def unexpected(rule: Rule) -> Column:
    """Predicate that is true for a row breaking a row-level rule."""
    c = F.col(rule.column)
    kw = rule.kwargs
    if rule.kind == NOT_NULL:
        return c.isNull()
    if rule.kind == BE_NULL:
        return c.isNotNull()
    if rule.kind == IN_SET:
        values = list(kw["value_set"])
        if kw.get("ignore_case"):
            return c.isNotNull() & ~F.upper(c).isin(sorted({str(v).upper() for v in values}))
        return c.isNotNull() & ~c.isin(values)
    if rule.kind == BETWEEN:
        return _range_violation(c, kw.get("min_value"), kw.get("max_value"),
                                kw.get("strict_min", False), kw.get("strict_max", False))
    if rule.kind == LENGTH_BETWEEN:
        return _range_violation(F.length(c), kw.get("min_value"), kw.get("max_value"), False, False)
    raise ValueError(f"not a row-level rule: {rule.kind}")


def _is_key_rule(rule: Rule) -> bool:
    return rule.kind in (UNIQUE, COMPOUND_UNIQUE)


def _is_table_rule(rule: Rule) -> bool:
    return "value_table" in rule.kwargs


def _row_rules(suite: Suite) -> list[Rule]:
    return [r for r in suite.rules if not _is_key_rule(r) and not _is_table_rule(r)]


def _row_metrics(rules: Sequence[Rule]) -> list[Column]:
    """One count for each rule, one of its values where ``mostly`` needs it, and the rows."""
    aggs = [F.count(F.lit(1)).alias("__n")]
    aggs += [F.count_if(unexpected(r)).alias(f"__u{i}") for i, r in enumerate(rules)]
    aggs += [(F.count(F.lit(1)) if r.kind in (NOT_NULL, BE_NULL) else F.count(F.col(r.column))).alias(f"__v{i}")
             for i, r in enumerate(rules) if r.mostly < 1]
    return aggs


def _passes(rule: Rule, i: int) -> Column:
    if rule.mostly == 1:
        return F.col(f"__u{i}") == 0
    return F.col(f"__v{i}") - F.col(f"__u{i}") >= F.col(f"__v{i}") * rule.mostly


def _result(suite: str, rule: Rule, n: Column, bad: Column, success: Column) -> Column:
    return F.struct(
        F.lit(suite).alias("suite"),
        F.lit(rule.kind).alias("rule"),
        F.lit(rule.column_name).alias("column_name"),
        n.cast("long").alias("element_count"),
        bad.cast("long").alias("unexpected_count"),
        success.alias("success"),
    )


def _row_results(one: DataFrame, suite: Suite, rules: Sequence[Rule]) -> DataFrame:
    return one.select(F.inline(F.array(*[
        _result(suite.name, r, F.col("__n"), F.col(f"__u{i}"), _passes(r, i)) for i, r in enumerate(rules)
    ])))


def run_row_rules_by(df: DataFrame, suite: Suite, by: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Row-level rules for each group of ``by`` in one pass: the results of all
    rows together, and the groups that break a rule. Both read the small table
    of counts, which is written to the shared folder."""
    rules = _row_rules(suite)
    counts = df.groupBy(*by).agg(*_row_metrics(rules))
    path = shared_path(df.sparkSession, "quality", uuid.uuid4().hex)
    counts.write.parquet(path)
    counts = df.sparkSession.read.schema(counts.schema).parquet(path)
    sums = counts.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counts.columns if c not in by])
    passes = F.lit(True)
    for i, r in enumerate(rules):
        passes = passes & _passes(r, i)
    results = _row_results(sums, suite, rules) if rules else df.sparkSession.createDataFrame([], QUALITY_RESULT_SCHEMA)
    return results, counts.where(~passes).select(*by)


def key_rules(suite: Suite) -> Suite:
    """The rules that need more than a row: uniqueness and sets in tables."""
    return Suite(suite.name, [r for r in suite.rules if _is_key_rule(r) or _is_table_rule(r)])


def _key_of(rule: Rule) -> Column:
    """The rule's key as one text; null where a part of it is null."""
    cols = [F.col(c) for c in (rule.column if isinstance(rule.column, tuple) else (rule.column,))]
    present = F.lit(True)
    for c in cols:
        present = present & c.isNotNull()
    return F.when(present, encode_values(*cols))


def _all_metrics(df: DataFrame, rows: Sequence[Rule], keys: Sequence[Rule]) -> DataFrame:
    """One row: what ``_row_metrics`` counts, and for each uniqueness rule
    (``__k0`` ...) the keys, every part of them not null, that occur more than once.

    Row rules are plain aggregates. With uniqueness rules a row becomes a line
    for each of them, (rule, key), and one more for the row rules, whose key is
    empty: one scan and one grouping for all rules. Lines are counted in every
    task first, so a hot key, like the row rules' one, sends one line from each.
    """
    row_aggs = _row_metrics(rows)
    if not keys:
        return df.agg(*row_aggs)
    # The same counts as sums of flags, which lines of other rules leave null.
    flags = {"__n": F.lit(1).cast("long")}
    flags |= {f"__u{i}": unexpected(r).cast("long") for i, r in enumerate(rows)}
    flags |= {f"__v{i}": (F.lit(True) if r.kind in (NOT_NULL, BE_NULL) else F.col(r.column).isNotNull()).cast("long")
              for i, r in enumerate(rows) if r.mostly < 1}
    lines = [F.struct(F.lit(-1).alias("__rule"), F.lit("").alias("__key"), *[c.alias(n) for n, c in flags.items()])]
    lines += [F.struct(F.lit(j).alias("__rule"), _key_of(r).alias("__key"),
                       *[F.lit(None).cast("long").alias(n) for n in flags]) for j, r in enumerate(keys)]
    each = df.select(F.inline(F.array(*lines))).where(F.col("__key").isNotNull())
    counts = each.groupBy("__rule", "__key").agg(F.count(F.lit(1)).alias("__c"), *[F.sum(n).alias(n) for n in flags])
    own = F.col("__rule") == -1
    return counts.agg(
        *[F.coalesce(F.max(F.when(own, F.col(n))), F.lit(0)).alias(n) for n in flags],
        *[F.count_if((F.col("__rule") == j) & (F.col("__c") > 1)).alias(f"__k{j}") for j in range(len(keys))])


def run_suite(df: DataFrame, suite: Suite) -> DataFrame:
    """All rules of the suite as result rows: one scan of ``df`` for all row-level
    and uniqueness rules, and one more for each set that is a table."""
    parts = [outside_table(df, suite.name, r) for r in suite.rules if _is_table_rule(r)]
    rows, keys = _row_rules(suite), [r for r in suite.rules if _is_key_rule(r)]
    if rows or keys:
        parts.insert(0, _one_scan(df, suite, rows, keys))
    if not parts:
        return df.sparkSession.createDataFrame([], QUALITY_RESULT_SCHEMA)
    return reduce(DataFrame.unionByName, parts)


def _one_scan(df: DataFrame, suite: Suite, rows: Sequence[Rule], keys: Sequence[Rule]) -> DataFrame:
    results = [_result(suite.name, r, F.col("__n"), F.col(f"__u{i}"), _passes(r, i)) for i, r in enumerate(rows)]
    results += [_result(suite.name, r, F.col("__n"), F.col(f"__k{j}"), F.col(f"__k{j}") == 0)
                for j, r in enumerate(keys)]
    return _all_metrics(df, rows, keys).select(F.inline(F.array(*results)))


#: Bytes of a set's values up to which it is sent to every task.
SET_BROADCAST_BYTES = 32 * 1024 * 1024
#: Bytes beside the text that a value takes in memory.
VALUE_OVERHEAD = 64


def outside_table(df: DataFrame, suite: str, rule: Rule, broadcast_bytes: int = SET_BROADCAST_BYTES) -> DataFrame:
    """One result row of a set rule whose values are a table.

    The column's values are counted first (in every task, then by value), so the
    join sees each different value once, however often it occurs. Nulls of the
    column are not looked for and nulls of the set match nothing, so a null in the
    set never makes a value fit (as NOT IN would have it). The set's size is
    measured: a small one is broadcast, a larger one is merged by value.
    """
    value = F.col(rule.column).cast("string")
    spark = df.sparkSession
    member = F.col(rule.kwargs["value_column"]).cast("string")
    if rule.kwargs.get("ignore_case"):
        value, member = F.upper(value), F.upper(member)
    members = spark.table(rule.kwargs["value_table"]).select(member.alias("value")).where("value is not null").distinct()
    size = members.agg(F.sum(F.octet_length("value") + VALUE_OVERHEAD)).first()[0] or 0
    members = F.broadcast(members) if size <= broadcast_bytes else members.hint("merge")
    counts = df.groupBy(value.alias("value")).agg(F.count(F.lit(1)).alias("n"))
    # Nulls count as rows, but never meet the set.
    outside = counts.where("value is not null").join(members, "value", "left_anti")
    sums = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("__n"),
                      F.coalesce(F.sum(F.when(F.col("value").isNotNull(), F.col("n"))), F.lit(0)).alias("__v0"))
    bad = outside.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("__u0"))
    return sums.join(bad).select(F.inline(F.array(
        _result(suite, rule, F.col("__n"), F.col("__u0"), _passes(rule, 0)))))


def observe_suite(df: DataFrame, suite: Suite):
    """Attach the suite's row-level rules to ``df`` as observed metrics.

    Returns ``(observed_df, observation)``; the counts are computed by the
    first action on ``observed_df`` (e.g. its write), with no extra pass.
    Use it for suites that report; a gate must run before the write
    (``validate``). Key rules need their own grouping and are not observed.
    """
    from pyspark.sql import Observation

    rules = _row_rules(suite)
    obs = Observation(f"suite_{suite.name}")
    return df.observe(obs, *_row_metrics(rules)), obs


def observation_results(suite: Suite, obs) -> list[dict]:
    """Result rows (same shape as ``run_suite``) from a finished observation."""
    rules = _row_rules(suite)
    got = obs.get
    return [{"suite": suite.name, "rule": r.kind, "column_name": r.column_name,
             "element_count": int(got["__n"]), "unexpected_count": int(got[f"__u{i}"]),
             "success": int(got[f"__u{i}"]) == 0 if r.mostly == 1 else
             got[f"__v{i}"] - got[f"__u{i}"] >= got[f"__v{i}"] * r.mostly} for i, r in enumerate(rules)]


def observed_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values with their counts (distributed; safe at high cardinality)."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))


def gate(results: DataFrame) -> list[dict]:
    """Collect the (rule-count sized) results; raise if any rule failed."""
    rows = [r.asDict() for r in results.collect()]
    failed = [r for r in rows if not r["success"]]
    if failed:
        raise QualityGateError(failures(failed))
    return rows


def failures(failed: Iterable[dict]) -> str:
    return "suite failed: " + "; ".join(
        f"{r['rule']}({r['column_name']}): {r['unexpected_count']} of {r['element_count']}" for r in failed)


def run_summary(results: Iterable[dict]) -> dict:
    """The run as a whole: success and how many rules passed."""
    rows = list(results)
    passed = sum(bool(r["success"]) for r in rows)
    return {"success": passed == len(rows), "evaluated_rules": len(rows), "successful_rules": passed,
            "unsuccessful_rules": len(rows) - passed}


def validate(df: DataFrame, suite: Suite) -> list[dict]:
    """Run the suite on ``df`` and stop (raise) when it fails."""
    return gate(run_suite(df, suite))


def results_json(results: DataFrame) -> DataFrame:
    """Result rows as JSON text (one object per rule)."""
    return results.select(F.to_json(F.struct(*results.columns)).alias("result_json"))
