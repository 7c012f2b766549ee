"""Discount-rule lookup: exactly one rule must match a request."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.operators.intervals import covering

_MATCH_COLUMNS = [
    "internet_product_group",
    "contract_months",
    "mobile_total_fee_min",
    "mobile_total_fee_max",
    "mobile_line_fee_min",
    "mobile_line_fee_max",
    "discount_amount",
]


def with_rules(
    df: DataFrame, rules: DataFrame, group: str = "internet_product_group",
    months: str = "internet_contract_months", **kinds: tuple[str, str, str],
) -> DataFrame:
    """Add array columns with the rules of (discount, method, rule type) that share a row's group and term.

    Rules are joined on the term and on the group, or on the term alone where a rule is for `ANY` group, so a
    row carries only rules whose fee range it has to be compared with. Catalogues of any size work.
    """
    for name, (discount_id, method, rule_type) in kinds.items():
        chosen = rules.where(
            (F.col("discount_id") == discount_id)
            & (F.col("bundle_discount_method") == method)
            & (F.col("rule_type") == rule_type)
        )
        row = F.collect_list(F.struct(*_MATCH_COLUMNS))
        any_group = F.col("internet_product_group") == "ANY"
        for part, keys in (("_own", ["internet_product_group", "contract_months"]), ("_any", ["contract_months"])):
            of_part = chosen.where(any_group if part == "_any" else ~any_group)
            found = of_part.groupBy(*keys).agg(row.alias(name + part)).select(
                *[F.col(key).alias(f"{name}_{key}") for key in keys], name + part
            )
            same = [
                F.col(f"{name}_{key}") == F.col(months if key == "contract_months" else group) for key in keys
            ]
            df = df.join(found, same, "left").drop(*[f"{name}_{key}" for key in keys])
        both = [F.coalesce(name + part, F.array()) for part in ("_own", "_any")]
        df = df.withColumn(name, F.concat(*both)).drop(name + "_own", name + "_any")
    return df


def within(value: Column, lower: Column, upper: Column) -> Column:
    """Inclusive range whose missing bounds are open."""
    return (lower.isNull() | (value >= lower)) & (upper.isNull() | (value <= upper))


def group_matches(rule_group: Column, group: Column) -> Column:
    return rule_group.isin("ANY") | (rule_group == group)


def matching_rules(
    rules: str,
    group: Column,
    months: Column,
    mobile_total: Column | None = None,
    line_fee: Column | None = None,
) -> Column:
    """Rules of an array column that fit a request; `ANY` as a rule's group fits every group."""
    def matches(rule: Column) -> Column:
        hit = group_matches(rule["internet_product_group"], group) & (
            rule["contract_months"] == months
        )
        if mobile_total is not None:
            hit = hit & within(
                mobile_total, rule["mobile_total_fee_min"], rule["mobile_total_fee_max"]
            )
        if line_fee is not None:
            hit = hit & within(line_fee, rule["mobile_line_fee_min"], rule["mobile_line_fee_max"])
        return hit

    return F.filter(F.col(rules), matches)


def only_amount(matches: Column, label: str) -> Column:
    """Amount of the single matching rule; none or several matches fail the job."""
    found = F.concat(F.lit(f"{label}: matching rules "), F.size(matches).cast("string"))
    return F.when(F.size(matches) == 1, matches[0]["discount_amount"]).otherwise(
        F.raise_error(found).cast("decimal(12,2)")
    )


def with_amounts(
    df: DataFrame, rules: DataFrame, group: str = "internet_product_group", months: str = "internet_contract_months",
    **kinds: tuple[tuple[str, str, str], str | None, str | None],
) -> DataFrame:
    """Add the amount of the single rule of each kind that fits a row; none or several matches fail the job.

    A kind is (discount, method, rule type), the fee column of df and the bounds it has to lie in (`mobile_total_fee`
    or `mobile_line_fee`), both None where fees do not matter. Rules are joined as disjoint fee pieces, those of the
    row's group and those for `ANY` group each for themselves, so no row carries a list of rules.
    """
    for name, ((discount_id, method, rule_type), fee, bounds) in kinds.items():
        chosen = rules.where(
            (F.col("discount_id") == discount_id)
            & (F.col("bundle_discount_method") == method)
            & (F.col("rule_type") == rule_type)
        )
        any_group = F.col("internet_product_group") == "ANY"
        on = {group: "internet_product_group", months: "contract_months"}
        limits = [f"{bounds or 'mobile_total_fee'}_{end}" for end in ("min", "max")]
        for part, of_part, keys in (
            ("own", chosen.where(~any_group), on), ("any", chosen.where(any_group), {months: "contract_months"}),
        ):
            value = F.col(fee) if fee else None
            df = covering(df, of_part, keys, value, *limits, "discount_amount", f"{name}_{part}")
        count = F.col(f"{name}_own_n") + F.col(f"{name}_any_n")
        found = F.concat(F.lit(f"{name.replace('_', ' ').strip()}: matching rules "), count.cast("string"))
        amount = (F.col(f"{name}_own_total") + F.col(f"{name}_any_total")).cast("decimal(12,2)")
        df = df.withColumn(name, F.when(count == 1, amount).otherwise(F.raise_error(found).cast("decimal(12,2)")))
        df = df.drop(*[f"{name}_{part}_{c}" for part in ("own", "any") for c in ("n", "total")])
    return df
