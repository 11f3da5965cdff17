"""Field plan: which rule owns each requested field.

The plan depends only on (label, field name, description), never on the text,
so it is a cheap per-row string expression: no join, no shuffle. Each field is
case-folded once; the cascades then only run ``contains`` tests and yield a rule
number, from which the extractor index and the rule name are looked up in
literal arrays.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docsift.operators.rules import DEFAULT, RuleBank, RuleSet
from docsift.operators.rules.bank import FieldView


def family(label: Column, rules: RuleSet = DEFAULT) -> Column:
    """Route a label to its bank: the first bank whose keyword the lower-cased label contains."""
    low = F.lower(label)
    out = None
    for bank in rules.label_banks:
        cond = low.contains(bank.label_keyword)
        out = F.when(cond, F.lit(bank.family)) if out is None else out.when(cond, F.lit(bank.family))
    return out


def _cascade(bank: RuleBank, view: FieldView, rules: RuleSet) -> Column:
    """CASE over the bank's triggers in order -> global rule number (null: no trigger)."""
    out = None
    for rule in bank.rules:
        num = F.lit(rules.rule_index[(bank.family, rule.name)])
        cond = rule.trigger(view)
        out = F.when(cond, num) if out is None else out.when(cond, num)
    return out


def _label_cascade(fam: Column, view: FieldView, rules: RuleSet) -> Column:
    out = None
    for bank in rules.label_banks:
        arm = _cascade(bank, view, rules)
        cond = fam == F.lit(bank.family)
        out = F.when(cond, arm) if out is None else out.when(cond, arm)
    return out


def _folded(fields: Column) -> Column:
    return F.transform(fields, lambda f: F.struct(
        f["ord"].alias("ord"), f["field"].alias("field"), f["description"].alias("description"),
        F.lower(f["field"]).alias("lf"), F.upper(f["field"]).alias("uf"),
        F.upper(f["description"]).alias("ud")))


def rule_numbers(label: Column | None, fields: Column, rules: RuleSet = DEFAULT,
                 bank: Column | None = None) -> Column:
    """``array<struct<ord, field, description, label_r, generic_r>>`` (global rule numbers)."""
    fam = family(label, rules) if bank is None else bank

    def plan_one(g: Column) -> Column:
        view = FieldView(lower=g["lf"], upper=g["uf"], desc_upper=g["ud"], desc=g["description"])
        return F.struct(
            g["ord"].alias("ord"), g["field"].alias("field"), g["description"].alias("description"),
            _label_cascade(fam, view, rules).alias("label_r"),
            _cascade(rules.generic_bank, view, rules).alias("generic_r"),
        )

    return F.transform(_folded(fields), plan_one)


def field_plan(label: Column | None, fields: Column, rules: RuleSet = DEFAULT,
               bank: Column | None = None) -> Column:
    """``array<struct<ord, field, description, label_rule, generic_rule, label_x, generic_x>>``.

    ``label_x`` / ``generic_x`` are extractor indexes (null when no rule of that
    bank triggers); ``*_rule`` are readable rule names for reports. The label's bank
    may be given instead of the label.
    """
    names = F.array(*[F.lit(n) for n in rules.rule_names])
    extractors = F.array(*[F.lit(x) for x in rules.rule_extractor])
    return F.transform(rule_numbers(label, fields, rules, bank), lambda p: F.struct(
        p["ord"].alias("ord"), p["field"].alias("field"), p["description"].alias("description"),
        F.get(names, p["label_r"]).alias("label_rule"),
        F.get(names, p["generic_r"]).alias("generic_rule"),
        F.get(extractors, p["label_r"]).alias("label_x"),
        F.get(extractors, p["generic_r"]).alias("generic_x"),
    ))
