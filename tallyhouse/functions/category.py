"""Product category from free text, as one ordered rule table."""

from __future__ import annotations

from collections import namedtuple
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..operators.patterns import needed_literals

# field:  raw | product | product_category, the text that is searched
# kind:   fill        sets the category when no earlier rule has
#         fill_no_raw the same, but only when the raw category is missing
#         override    sets the category whatever came before
#         exact       override on equality with one of `pattern` (a list)
Rule = namedtuple("Rule", "category field pattern kind")

# The rule table, in the order the rules apply.
_EDIBLE = (r"((?<!non)(?<!non )(?<!non-)edible)"
           r"|(gummies|gummy|lozenge|chocolate|candy|brownies)|(baked goods?)|(chews)")
_FLOWER_PACKS = r"(pre-packaged|prepack|eighths)|(((3\.5|7|14)g special)|quarter|eighth)"
_EXTRACT = (r"extract|concentrate|budder|shatter|badder|live resin|live rosin|wax|live diamonds"
            r"|sauce")
_BUD_NAMES = ["bud", "buds", "bulkbud", "packed bud", "packedbud"]
STRICT_RULES = [
    Rule("DRINKS", "raw", r"drink|beverage", "fill"),
    Rule("DRINKS", "product", r"DRINK|BEVERAGE", "fill"),
    Rule("TABLETS_CAPSULES", "raw", r"tablet|pill|capsule", "fill"),
    Rule("TABLETS_CAPSULES", "product", r"TABLET|CAPSULE", "fill"),
    Rule("EDIBLES", "raw", _EDIBLE, "fill"),
    Rule("EDIBLES", "product", r"GUMMIES|CHEWS", "fill_no_raw"),
    Rule("VAPES", "raw", r"pods|vape|cart|vapor|disposable|vaping", "fill"),
    Rule("BATTERIES", "raw", r"batteries|battery", "fill"),
    Rule("BATTERIES", "product", r"BATTER(Y|IES)", "fill"),
    Rule("VAPES", "product", r"CARTRIDGE", "fill_no_raw"),
    Rule("VAPES", "product", r"C-CELL", "fill"),
    Rule("PREROLLS", "raw", r"pre( |\-)?roll|joint|blunt", "override"),
    Rule("PREROLLS", "product", r"PRE( |\-)?ROLL", "fill"),
    Rule("FLOWER", "raw", _BUD_NAMES, "exact"),
    Rule("FLOWER", "raw", r"flower", "fill"),
    Rule("FLOWER", "product", r"SHAKE", "fill"),
    Rule("FLOWER", "raw", _FLOWER_PACKS, "fill"),
    Rule("FLOWER", "product_category", r"FLOWER", "fill"),
    Rule("EXTRACTS", "raw", _EXTRACT, "fill"),
    Rule("EXTRACTS", "product", r"SYRINGE", "fill"),
    Rule("EXTRACTS", "raw", r"distillate|applicator", "fill"),
    Rule("TINCTURES", "raw", r"tincture", "fill"),
    Rule("TINCTURES", "product", r"TINCTURE", "fill_no_raw"),
    Rule("TOPICALS", "raw", r"topical|ointment|bath bomb|balm|bath salt", "fill"),
    Rule("TOPICALS", "product", r"TRANSDERMAL|TOPICAL", "fill"),
    Rule("TOPICALS", "product_category", r"TRANSDERMAL|TOPICAL", "fill"),
    Rule("ACCESSORIES", "raw",
         r"accessor|non( |\-)?cannabis|merch|apparel|clothes|clothing|shirt", "fill"),
    Rule("DRINKS", "product", r"SYRUP", "fill"),
    Rule("EXTRACTS", "raw", r"crumble|rosin|sugar|diamonds", "fill"),
    Rule("FLOWER", "raw", r"(smalls|shake) (indica|hybrid|sativa)", "fill"),
    Rule("TABLETS_CAPSULES", "raw", r"sublingual", "fill"),
    Rule("FLOWER", "raw", r"pre pack (3\.5|14)", "fill"),
    Rule("ACCESSORIES", "raw", r"paraphernalia|gear", "fill"),
    Rule("EXTRACTS", "raw", r"hash|kief|resin|solventless", "fill"),
    Rule("ACCESSORIES", "raw", r"clone|plant", "fill"),
    Rule("TOPICALS", "raw", r"cream/lotion", "fill"),
    Rule("VAPES", "raw", r"pod|vaping", "fill"),
    Rule("FLOWER", "product", r"flower", "fill"),
    Rule("VAPES", "product", r"cart|disposable", "fill"),
]

# The names a category column can hold, in report order.
CATEGORY_LEVELS = ["FLOWER", "PREROLLS", "VAPES", "EXTRACTS", "EDIBLES", "DRINKS",
                   "TABLETS_CAPSULES", "TINCTURES", "TOPICALS", "ACCESSORIES", "OTHER"]


def _rule_hit(rule: Rule, fields: dict[str, Column], ignore_case: bool) -> Column:
    text = fields[rule.field]
    if rule.kind == "exact":
        return text.isin(list(rule.pattern))
    pattern = ("(?i)" if ignore_case else "") + rule.pattern
    hit, pieces = text.rlike(pattern), needed_literals(pattern) or []
    if "lower " + rule.field in fields and pieces and "".join(pieces).isascii():
        # Every match holds one of these pieces; to look for them is much cheaper than to try the expression.
        hit = reduce(or_, [fields["lower " + rule.field].contains(piece) for piece in pieces]) & hit
    return hit & fields["raw"].isNull() if rule.kind == "fill_no_raw" else hit


def apply_rules(raw: Column, product: Column, product_category: Column | None = None,
                rules: list[Rule] = STRICT_RULES, ignore_case: bool = False) -> Column:
    """Category of a product, NULL when no rule matches.

    A later override replaces everything before it and blocks every later fill,
    so the result is: the last override that matches, else the first fill that
    does. Written that way the whole table is two ``coalesce`` lists whose size
    grows with the number of rules, not with its square.
    """
    return _first_category({"raw": raw, "product": product,
                            "product_category": F.lit(None).cast("string") if product_category is None
                            else product_category}, rules, ignore_case)


def _apply_many_rules(texts: dict[str, Column], rules: list[Rule], ignore_case: bool = False) -> Column:
    """``apply_rules`` for a long table: each text is worked out once for all rules, as the fields of an array's only element."""
    known = {**texts, **{f"lower {name}": F.lower(text) for name, text in texts.items()}}
    row = F.array(F.struct(*[text.alias(name) for name, text in known.items()]))
    return F.element_at(F.transform(row, lambda r: _first_category({name: r[name] for name in known}, rules, ignore_case)), 1)


def _first_category(fields: dict[str, Column], rules: list[Rule], ignore_case: bool) -> Column:
    overrides, fills = [], []
    for rule in rules:
        branch = F.when(_rule_hit(rule, fields, ignore_case), F.lit(rule.category))
        (overrides if rule.kind in ("override", "exact") else fills).append(branch)
    return F.coalesce(*reversed(overrides), *fills, F.lit(None).cast("string"))


def _batteries_merged(rules: list[Rule]) -> list[Rule]:
    return [rule._replace(category="ACCESSORIES") if rule.category == "BATTERIES" else rule for rule in rules]


def strict_category(raw: Column, product: Column, product_category: Column) -> Column:
    """Case-sensitive variant on (lower, upper, upper) text; no match is NULL.

    The last two rules look for lower-case words in an upper-case title and so
    never fire here; they are kept because the other variant does use them.
    """
    return _apply_many_rules({"raw": F.lower(raw), "product": F.upper(product), "product_category": F.upper(product_category)},
                             _batteries_merged(STRICT_RULES))


def _ignore_case_rules() -> list[Rule]:
    """The same table with its two differences: no product-category rules, and
    the product title may turn anything into TABLETS_CAPSULES."""
    out = []
    for rule in STRICT_RULES:
        if rule.field == "product_category":
            continue
        if rule.category == "TABLETS_CAPSULES" and rule.field == "product":
            rule = rule._replace(kind="override")
        out.append(rule)
    return out


IGNORE_CASE_RULES = _ignore_case_rules()


def ignore_case_category(raw: Column, product: Column) -> Column:
    """Case-insensitive variant; no match is OTHER, blank raw text is missing.

    Text is upper-cased first, so the exact lower-case bud names never match.
    """
    raw_up = F.nullif(F.upper(raw), F.lit(""))
    found = _apply_many_rules({"raw": raw_up, "product": F.upper(product)}, _batteries_merged(IGNORE_CASE_RULES),
                              ignore_case=True)
    return F.coalesce(found, F.lit("OTHER"))
