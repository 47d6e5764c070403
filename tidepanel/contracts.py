"""Table contracts: which columns a table must have, their types, and the rules on their values."""

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepanel.config import DAY, KEY, SCOPE, TARGET
from tidepanel.session import settle


class ContractError(ValueError):
    """``values`` has, for each column with values that are not allowed, all of them with their counts."""

    def __init__(self, message: str, values: dict[str, DataFrame] | None = None):
        super().__init__(message)
        self.values = values or {}


@dataclass(frozen=True)
class Contract:
    required: dict[str, str]
    optional: dict[str, str] = field(default_factory=dict)
    key: tuple[str, ...] = ()
    allowed: dict[str, tuple[str, ...]] = field(default_factory=dict)


# The column names and types of the tables that stages exchange.
CONTRACTS = {
    "panel": Contract({KEY: "string", DAY: "date", TARGET: "double"}, key=(KEY, DAY)),
    "forecast": Contract(
        {KEY: "string", DAY: "date", TARGET: "double", "model": "string", "y_hat": "double", "cutoff": "date",
         "stage": "string"},
        optional={"lo_80": "double", "hi_80": "double"},
        key=(KEY, DAY, "model", "cutoff"),
    ),
    "scoring": Contract(  # forecasts of days that have not come yet
        {KEY: "string", DAY: "date", "model": "string", "y_hat": "double", "cutoff": "date", "stage": "string"},
        optional={"lo_80": "double", "hi_80": "double"},
        key=(KEY, DAY, "model", "cutoff"),
    ),
    "score": Contract(
        {"model": "string", "metric": "string", "score": "double", "stage": "string",
         "aggregation_scope": "string", "subset_name": "string"},
        allowed={"aggregation_scope": (SCOPE,)},
    ),
    "leaderboard": Contract(
        {"model": "string", "stage": "string", "subset_name": "string", "wMAPE": "double"},
        optional={"Bias": "double", "IntervalScore_80": "double", "Coverage_80": "double"},
    ),
}


def get_contract(name: str) -> Contract:
    if name not in CONTRACTS:
        raise ContractError(f"unknown contract {name!r}; known: {sorted(CONTRACTS)}")
    return CONTRACTS[name]


def missing_columns(df: DataFrame, contract: str) -> list[str]:
    """Required columns ``df`` lacks. Looks at the schema only, runs no job."""
    return [c for c in get_contract(contract).required if c not in df.columns]


def _as(column: str, to: str) -> Column:
    return F.col(column).try_cast(to)


def _typed(column: str, to: str) -> Column:
    value = _as(column, to)
    return F.when(~F.isnan(value), value) if to == "double" else value


def conform(df: DataFrame, contract: str, name: str = "table") -> DataFrame:
    """Cast the contract's columns lazily; NaN becomes NULL. Other columns pass unchanged."""
    rules = get_contract(contract)
    missing = missing_columns(df, contract)
    if missing:
        raise ContractError(f"[{name}] missing required columns {missing}; found {df.columns}")
    types = {**rules.required, **{c: t for c, t in rules.optional.items() if c in df.columns}}
    return df.withColumns({c: _typed(c, t) for c, t in types.items()})


def enforce(df: DataFrame, contract: str, name: str = "table") -> DataFrame:
    """``conform`` with the checks inside the plan: the job that meets a bad value fails and names its column.

    Costs no pass of its own, and a write that fails publishes nothing. ``validate`` counts violations first.
    """
    rules = get_contract(contract)
    typed = conform(df, contract, name)
    types = {**rules.required, **{c: t for c, t in rules.optional.items() if c in df.columns}}
    checked = {}
    for c, t in types.items():
        value = F.col(f"typed.{c}")
        bad = value.isNull() if c in rules.required else F.col(f"raw.{c}").isNotNull() & value.isNull()
        if c in rules.allowed:
            bad = bad | ~value.isin(*rules.allowed[c])
        problem = F.raise_error(F.concat(
            F.lit(f"[{name}] bad value in column {c}: "), F.coalesce(F.col(f"raw.{c}").cast("string"), F.lit("NULL"))))
        checked[c] = F.when(bad, problem.cast(t)).otherwise(value).alias(c)
    pairs = df.select(F.struct("*").alias("raw"), F.struct(*[
        _typed(c, t).alias(c) for c, t in types.items()]).alias("typed"))
    return pairs.select(*[checked.get(c, F.col(f"raw.{c}")) for c in typed.columns])


def contract_counts(df: DataFrame, contract: str) -> DataFrame:
    """One row of violation counts, from one pass over ``df``.

    ``cast__c`` counts values lost by the cast of c, ``null__c`` missing values of a required column and
    ``rule__c`` values outside the allowed list.
    """
    rules = get_contract(contract)
    types = {**rules.required, **{c: t for c, t in rules.optional.items() if c in df.columns}}
    counts = [F.count(F.lit(1)).alias("n_rows")]
    for c, t in types.items():
        lost = F.col(c).isNotNull() & _as(c, t).isNull()
        counts.append(F.count_if(lost).alias(f"cast__{c}"))
        if c in rules.required:
            empty = _as(c, t).isNull()
            if t == "double":
                empty = empty | F.isnan(_as(c, t))
            counts.append(F.count_if(empty).alias(f"null__{c}"))
    for c, values in rules.allowed.items():
        counts.append(F.count_if(~F.col(c).isin(*values)).alias(f"rule__{c}"))
    return df.agg(*counts)


def contract_report(df: DataFrame, contract: str) -> DataFrame:
    """The same counts as rows (check, column_name, bad_rows, n_rows)."""
    counts = contract_counts(df, contract)
    cells = [c for c in counts.columns if c != "n_rows"]
    long = counts.unpivot("n_rows", cells, "cell", "bad_rows")
    part = F.split("cell", "__", 2)
    return long.select(part[0].alias("check"), part[1].alias("column_name"), "bad_rows", "n_rows")


def disallowed_values(df: DataFrame, contract: str, column: str) -> DataFrame:
    """Distinct values of ``column`` that the contract does not allow, with their counts."""
    allowed = get_contract(contract).allowed[column]
    return df.filter(~F.col(column).isin(*allowed)).groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))


def duplicate_keys(df: DataFrame, contract: str) -> DataFrame:
    """Key values that occur more than once."""
    key = get_contract(contract).key
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def validate(df: DataFrame, contract: str, name: str = "table", unique: bool = False) -> DataFrame:
    """Check ``df`` and return it with the contract's types; raise on the first kind of violation.

    ``df`` is stored first, so its plan runs once for the counts, the key and the result. ``unique`` also checks
    the key, which costs a shuffle.
    """
    missing = missing_columns(df, contract)
    stored = df if missing else settle(df, "validated")
    out = conform(stored, contract, name)
    row = contract_counts(stored, contract).first().asDict()
    for kind, text in (("cast", "values cannot be cast"), ("rule", "values not allowed"), ("null", "null values")):
        bad = {c.split("__", 1)[1]: n for c, n in row.items() if c.startswith(kind + "__") and n}
        if not bad:
            continue
        values = {c: disallowed_values(stored, contract, c) for c in bad} if kind == "rule" else {}
        shown = {c: _spread(v, c) for c, v in values.items()} or bad
        raise ContractError(f"[{name}] {text}: {shown} of {row['n_rows']} rows", values)
    if unique and not duplicate_keys(out, contract).isEmpty():
        raise ContractError(f"[{name}] repeated keys {get_contract(contract).key}")
    return out


def _spread(values: DataFrame, column: str) -> str:
    """How many rows and different values, and the first and last of these."""
    n, rows, least, most = values.agg(F.count(F.lit(1)), F.sum("n_rows"), F.min(column), F.max(column)).first()
    return f"{rows} rows with {n} values from {least!r} to {most!r}"
