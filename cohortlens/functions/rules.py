"""Bands, first-match rule tables and display formatting as native column expressions (EX1-EX15).

Every function here returns a ``Column`` (codegen'd, no Python on the row path). The ``*_sql``
twins render the same rule tables as SQL text for the DuckDB oracles.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cohortlens import config as C


def band(col: Column, edges: tuple[float, float], names: tuple[str, str, str]) -> Column:
    """EX1-EX3: value < lo -> names[0]; < hi -> names[1]; else names[2] (null/NaN fall to the last)."""
    lo, hi = edges
    return F.when(col < F.lit(float(lo)), names[0]).when(col < F.lit(float(hi)), names[1]).otherwise(names[2])


def band_sql(expr: str, edges: tuple[float, float], names: tuple[str, str, str]) -> str:
    lo, hi = edges
    return f"(CASE WHEN {expr} < {float(lo)!r} THEN '{names[0]}' WHEN {expr} < {float(hi)!r} THEN '{names[1]}' ELSE '{names[2]}' END)"


def _cond(cond: dict, cols: dict[str, Column]) -> Column:
    out = F.lit(True)
    for key, allowed in cond.items():
        if key == "share_gt":
            out = out & (cols["share"] > F.lit(float(allowed)))
        else:
            out = out & cols[key].isin(list(allowed))
    return out


def _cond_sql(cond: dict, cols: dict[str, str]) -> str:
    parts = []
    for key, allowed in cond.items():
        if key == "share_gt":
            parts.append(f"{cols['share']} > {float(allowed)!r}")
        else:
            parts.append(f"{cols[key]} IN ({', '.join(_q(a) for a in allowed)})")
    return " AND ".join(parts) if parts else "TRUE"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def rule_index(rules, cols: dict[str, Column]) -> Column:
    """Index (0-based) of the first rule whose conditions hold."""
    expr = None
    for i, (cond, _) in enumerate(rules):
        c = _cond(cond, cols)
        expr = F.when(c, F.lit(i)) if expr is None else expr.when(c, F.lit(i))
    return expr.otherwise(F.lit(len(rules) - 1))


def rule_index_sql(rules, cols: dict[str, str]) -> str:
    whens = " ".join(f"WHEN {_cond_sql(cond, cols)} THEN {i}" for i, (cond, _) in enumerate(rules))
    return f"(CASE {whens} ELSE {len(rules) - 1} END)"


def pick(index: Column, values: list) -> Column:
    """CASE index WHEN i THEN values[i] (values are literals or columns)."""
    expr = None
    for i, v in enumerate(values):
        v = v if isinstance(v, Column) else F.lit(v)
        expr = F.when(index == i, v) if expr is None else expr.when(index == i, v)
    return expr


def pick_sql(index: str, values: list[str]) -> str:
    whens = " ".join(f"WHEN {index} = {i} THEN {v}" for i, v in enumerate(values))
    return f"(CASE {whens} END)"


# --- the concrete rule sets ------------------------------------------------------------------

def band_columns(age: Column, income: Column, spending: Column, bands: C.Bands) -> dict[str, Column]:
    return {
        "age": band(age, bands.age, C.AGE_NAMES),
        "income": band(income, bands.income, C.INCOME_NAMES),
        "spending": band(spending, bands.spending, C.SPENDING_NAMES),
    }


def strategy(cols: dict[str, Column]) -> Column:
    """EX4 (batch): first-match marketing strategy; ``cols`` has income, spending, share."""
    return pick(rule_index(C.STRATEGY_RULES, cols), [text for _, text in C.STRATEGY_RULES])


def recommendation_and_priority(cols: dict[str, Column]) -> tuple[Column, Column]:
    """EX5 (interactive): (recommendation text, priority)."""
    idx = rule_index(C.PRIORITY_RULES, cols)
    return (pick(idx, [out[0] for _, out in C.PRIORITY_RULES]), pick(idx, [out[1] for _, out in C.PRIORITY_RULES]))


_BATCH_FIELDS = ("product", "priority", "reason", "conversion")
_INTERACTIVE_FIELDS = ("product", "price", "conversion", "priority", "reason", "strategy")


def _catalogue(rules, fields) -> list[Column]:
    return [F.array(*[F.struct(*[F.lit(v).alias(f) for f, v in zip(fields, item)]) for item in items])
            for _, items in rules]


def products_batch(cols: dict[str, Column]) -> Column:
    """EX6: array<struct<product,priority,reason,conversion>> chosen by the batch rule set."""
    return pick(rule_index(C.PRODUCT_RULES_BATCH, cols), _catalogue(C.PRODUCT_RULES_BATCH, _BATCH_FIELDS))


def products_interactive(cols: dict[str, Column]) -> Column:
    """EX7: array<struct<product,price,conversion,priority,reason,strategy>> (interactive rule set)."""
    return pick(rule_index(C.PRODUCT_RULES_INTERACTIVE, cols), _catalogue(C.PRODUCT_RULES_INTERACTIVE, _INTERACTIVE_FIELDS))


def demographic(age_band: Column) -> Column:
    """EX8: struct<demographic,behavior,approach>; unknown band -> the default row."""
    def row(name):
        d = C.DEMOGRAPHICS[name]
        return F.struct(F.lit(d[0]).alias("demographic"), F.lit(d[1]).alias("behavior"), F.lit(d[2]).alias("approach"))
    expr = None
    for name in C.DEMOGRAPHICS:
        expr = F.when(age_band == name, row(name)) if expr is None else expr.when(age_band == name, row(name))
    return expr.otherwise(row(C.DEFAULT_DEMOGRAPHIC))


def cluster_name(cluster: Column) -> Column:
    """EX9: 'Noise' for -1, else 'Cluster n'."""
    return F.when(cluster == -1, F.lit("Noise")).otherwise(F.format_string("Cluster %d", cluster))


def segment_text(age_band: Column, income_band: Column, spending_band: Column) -> Column:
    """EX10: 'age, income income, spending spending'."""
    return F.format_string("%s, %s income, %s spending", age_band, income_band, spending_band)


def fixed_text(x: Column, digits: int, grouped: bool = False) -> Column:
    """EX11: ``digits`` decimals of the binary value, ties to even, as Python's ``.nf`` and ``,.nf`` give them.

    The fraction is scaled to an integer (60 bits: exact from 1/256 on) and rounded in integer arithmetic; Spark's own
    rounding works on the shortest decimal text of a double, whose ties are not the value's."""
    two60, ten = F.lit(1 << 60).cast("decimal(20,0)"), 10 ** digits

    def let(value: Column, use) -> Column:  # computes ``value`` once, however often it is used
        return F.element_at(F.transform(F.array(value), use), 1)

    def rounded(whole: Column, scaled: Column, down: Column) -> Column:
        """whole * 10^digits + the fraction's digits, from the fraction times 2^60 * 10^digits and its quotient by 2^60."""
        rest = (scaled - down.cast("decimal(20,0)") * two60) * 2
        up = (rest > two60) | ((rest == two60) & ((whole * ten + down) % 2 == 1))
        return whole * ten + down + F.when(up, 1).otherwise(0)

    def shown(v: Column) -> Column:
        head = (v - v % ten) / ten
        head = F.format_number(head, 0) if grouped else head.cast("long").cast("string")
        return F.concat(head, F.lit("."), F.lpad((v % ten).cast("string"), digits, "0")) if digits else head

    size = F.abs(x)
    fraction = ((size - F.floor(size)) * F.lit(float(1 << 60))).cast("long").cast("decimal(20,0)") * F.lit(ten).cast("decimal(10,0)")
    text = let(fraction, lambda s: let(((s - s % two60) / two60).cast("long"), lambda q: let(rounded(F.floor(size).cast("long"), s, q), shown)))
    return F.when(x.isNull() | F.isnan(x), F.lit("nan")).when(size == F.lit(float("inf")), F.lit("inf")).otherwise(
        F.concat(F.when(x < 0, F.lit("-")).otherwise(F.lit("")), text))


def grouped_thousands(x: Column) -> Column:
    """EX11: integer part with thousands separators, rounded half-even like Python's ',.0f'."""
    return fixed_text(x, 0, grouped=True)


def capped(x: Column, cap: float = 5.0) -> Column:
    """EX12: min(x, cap) for display."""
    return F.least(x, F.lit(float(cap)))


def capped_label(x: Column, digits: int = 3) -> Column:
    """EX12: text label, 'inf' for an infinite score."""
    return fixed_text(x, digits)


def is_primary(priority: Column) -> Column:
    """EX13: priority text contains 'Primary'."""
    return priority.contains("Primary")


# --- SQL twins of the rule sets --------------------------------------------------------------

def strategy_sql(cols: dict[str, str]) -> str:
    return pick_sql(rule_index_sql(C.STRATEGY_RULES, cols), [_q(t) for _, t in C.STRATEGY_RULES])


def recommendation_sql(cols: dict[str, str]) -> tuple[str, str]:
    idx = rule_index_sql(C.PRIORITY_RULES, cols)
    return (pick_sql(idx, [_q(o[0]) for _, o in C.PRIORITY_RULES]), pick_sql(idx, [_q(o[1]) for _, o in C.PRIORITY_RULES]))


def catalogue_rows_sql(rules, fields, alias: str = "cat") -> str:
    """VALUES table (rule, rank, fields...) of a product rule set."""
    rows = []
    for i, (_, items) in enumerate(rules):
        for r, item in enumerate(items):
            rows.append("(" + ", ".join([str(i), str(r)] + [_q(v) for v in item]) + ")")
    return f"(VALUES {', '.join(rows)}) AS {alias}(rule, rnk, {', '.join(fields)})"


def demographics_rows_sql(alias: str = "demo") -> str:
    rows = ", ".join("(" + ", ".join([_q(k)] + [_q(v) for v in vals]) + ")" for k, vals in C.DEMOGRAPHICS.items())
    return f"(VALUES {rows}) AS {alias}(age_band, demographic, behavior, approach)"


BATCH_FIELDS = _BATCH_FIELDS
INTERACTIVE_FIELDS = _INTERACTIVE_FIELDS
quote = _q
