"""Personal data: generated candidates, boosted trees and calibrated thresholds, in Spark SQL only.

Base spans come from four patterns and their checks (address parts, Luhn,
digit counts); they always stay. Wider generators propose further, overlapping
spans: spelled-out addresses, other separators, numbers without a plus sign.
Each is sound or not by the structure of its kind (address parts, Luhn, digit
counts, shape of the domain, no dates, no thousands); only sound ones can be added.
Boosted trees score each proposal by format and context, without the marks that
set base forms apart (at sign, plus sign, separators). They are fitted to the
whole corpus: a sound proposal that overlaps a valid base span of its kind is a
positive; one that is not sound, or that overlaps base spans of other kinds only, a
negative; sound ones that touch no base span have no label. So the negatives
tell how often a format occurs by chance; a number that fails Luhn counts a ninth. Only counts per feature cell reach the
driver, and features are bucketed, so their number is bounded by the buckets
and not by the data. The fitted trees go back into the plan as a CASE
expression. Per kind, the threshold is the lowest score, even odds at least, at which the
labelled proposals of the calibration documents reach a precision; sound proposals
from there on that touch no base span are added.

There is no Python on the executors. Spans are code points, end exclusive.

Defined results: null text is empty and has no spans; kinds may overlap each
other; repeated rows are treated alike; a corpus without positives of a kind
adds nothing of that kind, one without negatives every sound proposal; of overlapping
proposals the best stays, of equal scores the first; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import crc_of_id, shielded

KINDS = ("email", "ip", "card", "phone")

# Each pattern finds the same matches as the plain form beside it. Possessive
# repeats and look-behinds only spare the search starts that must fail.
BASE = {
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    # [0-9]([\x20-]?[0-9])+, cut to chains of 13 to 19 digits
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])",
    # \+[0-9][\x20().0-9-]+[0-9]
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
PROPOSED = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?: at | ?(?:@|\(at\)|\[at\]) ?)[A-Za-z0-9-]++(?:(?:\. ?| ?\(dot\) ?| ?\[dot\] ?| dot )[A-Za-z0-9-]++){1,4}+",
    "ip": r"(?<![0-9])[0-9]{1,4}+(?:(?:[.,:_-]|\[\.\])[0-9]{1,4}+){3}+",
    "card": r"(?<![0-9])[0-9](?:[\x20._-]{0,2}+[0-9]){11,19}+",
    "phone": r"(?<![0-9])[+(]?[0-9](?:[\x20().-]{0,3}+[0-9]){6,14}+",
}
# Usual forms, proposed beside the longer chains that may swallow them.
GROUPED = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?: at | ?(?:@|\(at\)|\[at\]) ?)[A-Za-z0-9-]++(?:(?:\.| ?\(dot\) ?| ?\[dot\] ?| dot )[A-Za-z0-9-]++){1,4}+",
    "card": r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[\x20._-][0-9]{4}){3})(?![0-9])",
    "phone": r"(?<![0-9])(?:\+[0-9]{1,3}[\x20.-]?)?\(?[0-9]{2,4}\)?[\x20.-]?[0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9])",
}
# A cheap test that a text can hold a base match, and a proposal.
BASE_GATE = {"email": "contains(tm_text, '@')", "ip": "tm_number", "card": "tm_number", "phone": "contains(tm_text, '+')"}
GATE = {k: "tm_number" for k in KINDS} | {
    "email": "(contains(tm_text, '@') or contains(tm_text, '(at)') or contains(tm_text, '[at]') or "
    r"tm_text rlike r' at [A-Za-z0-9-]++(?:\. ?| ?\(dot\)| ?\[dot\]| dot )')"
}
# Context words, lower case, looked for shortly before a proposal.
CONTEXT = {
    "email": r"mail|contact|kontakt|correo|courriel|write",
    "ip": r"ip|host|server|address|adresse|dirección",
    "card": r"card|karte|carte|tarjeta|visa|credit|konto",
    "phone": r"phone|tel|call|fax|mobil|teléfono|ruf",
}
CONTEXT_CHARS = 24
ROUNDS, RATE, PRECISION = 24, 0.4, 0.9
# What one negative says about sound ones: of ten chance numbers nine fail Luhn and one passes.
CHANCE = {"email": 1.0, "ip": 1.0, "card": 1 / 9, "phone": 1.0}
FEATURES = ("size", "first", "second", "third", "before", "after", "context")
SPAN = "array<struct<start:int,end:int,hit:string>>"


def matches(text: str, pattern: str) -> str:
    """SQL for all matches with their code point spans, from the matches and the gaps between them."""
    quoted = "r'" + pattern.replace("'", r"\x27") + "'"
    return (
        f"aggregate(zip_with(split({text}, {quoted}, -1), regexp_extract_all({text}, {quoted}, 0), "
        "(gap, hit) -> struct(length(gap) as gap, hit as hit)), "
        f"struct(0 as at, cast(array() as {SPAN}) as found), "
        "(s, p) -> if(p.hit is null, s, struct(s.at + p.gap + length(p.hit) as at, concat(s.found, array(struct("
        "s.at + p.gap as start, s.at + p.gap + length(p.hit) as end, p.hit as hit))) as found)), s -> s.found)"
    )


def digits(hit: str) -> str:
    return f"regexp_replace({hit}, '[^0-9]', '')"


def luhn(hit: str) -> str:
    number = f"reverse({digits(hit)})"
    value = f"cast(substring({number}, i, 1) as int)"
    return (
        f"aggregate(sequence(1, greatest(length({number}), 1)), 0, (s, i) -> s + if(i % 2 = 0, "
        f"2 * {value} - if({value} > 4, 9, 0), {value})) % 10 = 0"
    )


def valid(kind: str, hit: str) -> str:
    """SQL for the check of a base match."""
    return {
        "email": "true",
        "ip": f"forall(split({hit}, r'\\.'), p -> coalesce(try_cast(p as decimal(38,0)), 256) <= 255)",
        "card": f"length({digits(hit)}) between 13 and 19 and {luhn(hit)}",
        "phone": f"length({digits(hit)}) between 9 and 15",
    }[kind]


def with_base(docs: DataFrame) -> DataFrame:
    """Adds tm_text and the base spans tm_email, tm_ip, tm_card, tm_phone."""
    empty = f"cast(array() as {SPAN})"
    held = docs.withColumn("tm_text", F.coalesce("text", F.lit(""))).withColumn("tm_number", F.expr("tm_text rlike '[0-9]'"))
    return held.withColumns({
        f"tm_{k}": F.expr(f"if({BASE_GATE[k]}, filter({matches('tm_text', BASE[k])}, m -> {valid(k, 'm.hit')}), {empty})")
        for k in KINDS
    })


def _groups(hit: str) -> str:
    """SQL for the runs of digits of a proposal."""
    return f"filter(split({hit}, '[^0-9]+'), x -> x <> '')"


# A proposal with the spelled-out marks of an address in their usual form.
_ADDRESS = r"regexp_replace(regexp_replace(p.hit, r' ?(?:@|\(at\)|\[at\]) ?| at ', '@'), r' ?\(dot\) ?| ?\[dot\] ?| dot ', '.')"
_DOMAIN = r"^[A-Za-z0-9][A-Za-z0-9._%+-]*@(?!www\.)(?:[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]{2,12}$"
_DATE = r"(?<![0-9])(?:(?:19|20)[0-9]{2}[-./ ][01]?[0-9][-./ ][0-3]?[0-9]|[0-3]?[0-9][-./ ][0-3]?[0-9][-./ ](?:19|20)[0-9]{2})(?![0-9])"
_THOUSANDS = r"^[0-9]{1,3}(?:\.[0-9]{3}|,[0-9]{3}| [0-9]{3})+$"


def _before() -> str:
    return f"lower(substring(tm_text, greatest(p.start - {CONTEXT_CHARS} + 1, 1), least(p.start, {CONTEXT_CHARS})))"


def _shape(char: str) -> str:
    return f"case when {char} = '' then 0 when {char} rlike '[0-9]' then 1 when {char} rlike r'[\\p{{L}}_@]' then 2 when {char} rlike r'\\s' then 3 else 4 end"


_LEFT, _RIGHT = "substring(tm_text, p.start, if(p.start > 0, 1, 0))", "substring(tm_text, p.end + 1, 1)"


def _context(kind: str) -> str:
    return rf"{_before()} rlike r'(?:^|[^\p{{L}}])(?:{CONTEXT[kind]})'"


def sound(kind: str) -> str:
    """SQL for the structural check of a proposal p in tm_text; it does not ask for the base form."""
    count, groups = f"length({digits('p.hit')})", _groups("p.hit")
    alone = f"not ({_LEFT} rlike r'[\\p{{L}}0-9_]' or {_RIGHT} rlike r'[\\p{{L}}0-9_]')"
    return {
        "email": f"{_ADDRESS} rlike r'{_DOMAIN}'",
        "ip": (
            f"{alone} and forall({groups}, x -> cast(x as int) <= 255 and (x = '0' or x not like '0%')) "
            f"and size(array_distinct(filter(split(p.hit, '[0-9]+'), x -> x <> ''))) = 1 and not p.hit rlike r'{_THOUSANDS}' "
            rf"and (p.hit rlike r'[0-9](?:\.|\[\.\])[0-9]' or size(filter({groups}, x -> length(x) = 3)) >= 2)"
        ),
        "card": f"{alone} and {valid('card', 'p.hit')} and forall({groups}, x -> length(x) >= 3) and not p.hit rlike r'{_DATE}|{_THOUSANDS}'",
        "phone": (
            f"{alone} and {count} between 9 and 15 and not p.hit rlike r'{_DATE}|{_THOUSANDS}' "
            f"and (size({groups}) > 1 or p.hit like '+%' or {_context('phone')})"
        ),
    }[kind]


def _features(kind: str) -> str:
    """SQL struct of bucketed features of a proposal p in tm_text, none of which tells a base form from others.

    Address: length and case of the last label. Address parts: digits, longest part.
    Card: digits, whether groups are even. Phone: longest group and the last three, from the end.
    """
    count, groups = f"least(length({digits('p.hit')}), 20)", _groups("p.hit")
    longest = f"least(array_max(transform({groups}, x -> length(x))), 6)"
    label = "regexp_extract(p.hit, '([A-Za-z0-9-]*)$', 1)"

    def at(place: int) -> str:
        return f"coalesce(least(length(try_element_at({groups}, {place})), 6), 0)"

    even = f"size(array_distinct(transform({groups}, x -> length(x)))) = 1"
    own = {
        "email": (f"least(length({label}), 8)", f"cast({label} rlike '[A-Z]' as int)", "0", "0"),
        "ip": (count, longest, "0", "0"),
        "card": (count, f"cast({even} as int)", "0", "0"),
        "phone": (longest, at(-1), at(-2), at(-3)),
    }[kind]
    named = ", ".join(f"{value} as {name}" for name, value in zip(FEATURES, own))
    return f"struct({named}, {_shape(_LEFT)} as before, {_shape(_RIGHT)} as after, cast({_context(kind)} as int) as context)"


def proposals(kind: str) -> str:
    found = matches("tm_text", PROPOSED[kind])
    return f"array_distinct(concat({found}, {matches('tm_text', GROUPED[kind])}))" if kind in GROUPED else found


def with_proposals(based: DataFrame) -> DataFrame:
    """Adds tm_wide_<kind>: proposals with features, whether sound, and whether they touch base spans of their or any kind."""
    empty = f"cast(array() as {SPAN})"
    gated = based.withColumns({
        f"tm_raw_{k}": F.expr(f"if({GATE[k]}, {proposals(k)}, {empty})")
        for k in KINDS
    })
    anything = "concat(" + ", ".join(f"tm_{k}" for k in KINDS) + ")"
    touch = "b -> b.start < p.end and p.start < b.end"
    return gated.withColumns({
        f"tm_wide_{k}": F.expr(
            f"transform(tm_raw_{k}, p -> struct(p.start as start, p.end as end, {_features(k)} as f, coalesce({sound(k)}, false) as sound, "
            f"exists(tm_{k}, {touch}) as own, exists({anything}, {touch}) as taken))"
        )
        for k in KINDS
    }).drop(*(f"tm_raw_{k}" for k in KINDS))


# ------------------------------------------------------------------ boosted trees over counted cells


def _leaf(cells, weight_sum):
    gradient = sum(c["g"] for c in cells)
    return gradient / (weight_sum + 1.0)


def _best_split(cells):
    """The (feature, limit) with the largest Newton gain for f <= limit, or None."""
    best, gain = None, 1e-6
    total_g, total_h = sum(c["g"] for c in cells), sum(c["h"] for c in cells)
    for feature in FEATURES:
        sums: dict[int, list[float]] = {}
        for c in cells:
            s = sums.setdefault(c[feature], [0.0, 0.0])
            s[0] += c["g"]
            s[1] += c["h"]
        g = h = 0.0
        for value in sorted(sums)[:-1]:
            g, h = g + sums[value][0], h + sums[value][1]
            won = g * g / (h + 1.0) + (total_g - g) ** 2 / (total_h - h + 1.0) - total_g**2 / (total_h + 1.0)
            if won > gain:
                best, gain = (feature, value), won
    return best


def _tree(cells, depth: int):
    split = _best_split(cells) if depth else None
    if split is None:
        return _leaf(cells, sum(c["h"] for c in cells)) * RATE
    feature, limit = split
    low, high = [c for c in cells if c[feature] <= limit], [c for c in cells if c[feature] > limit]
    return (feature, limit, _tree(low, depth - 1), _tree(high, depth - 1))


def tree_value(tree, cell) -> float:
    while isinstance(tree, tuple):
        tree = tree[2] if cell[tree[0]] <= tree[1] else tree[3]
    return tree


def tree_sql(tree) -> str:
    if not isinstance(tree, tuple):
        return f"{tree!r}D"
    return f"if(p.f.{tree[0]} <= {tree[1]}, {tree_sql(tree[2])}, {tree_sql(tree[3])})"


def boost(cells: list[dict], rounds: int = ROUNDS, depth: int = 2) -> list:
    """Logistic boosting on cells with ``pos`` and ``neg`` counts."""
    for c in cells:
        c["score"] = 0.0
    trees = []
    for _ in range(rounds):
        for c in cells:
            p = 1.0 / (1.0 + math.exp(-c["score"]))
            c["g"] = c["pos"] * (1.0 - p) - c["neg"] * p
            c["h"] = (c["pos"] + c["neg"]) * p * (1.0 - p)
        tree = _tree(cells, depth)
        trees.append(tree)
        for c in cells:
            c["score"] += tree_value(tree, c)
    return trees


def threshold(cells: list[dict], trees: list, precision: float = PRECISION) -> float | None:
    """The lowest score, 0 at least, from which the cells reach the precision; None if no score does."""
    scored = sorted(((sum(tree_value(t, c) for t in trees), c["pos"], c["neg"]) for c in cells), reverse=True)
    chosen, pos, neg = None, 0, 0
    for i, (score, p, n) in enumerate(scored):
        pos, neg = pos + p, neg + n
        last = i + 1 == len(scored) or scored[i + 1][0] < score
        if last and pos and pos >= precision * (pos + neg):
            chosen = score
    return None if chosen is None else max(chosen, 0.0)


def fit(proposed: DataFrame) -> dict[str, tuple[list, float]]:
    """Trees and threshold per kind. One document in four calibrates, by crc32 of its id."""
    fold = (crc_of_id() % 4 == 1).alias("calibrates")
    parts = None
    for kind in KINDS:
        good, bad = F.expr("p.own and p.sound"), F.expr("not p.own and (p.taken or not p.sound)")
        rows = proposed.select(fold, F.explode(f"tm_wide_{kind}").alias("p")).where(good | bad).select(
            F.lit(kind).alias("kind"), "calibrates", "p.f.*", good.cast("long").alias("pos"), bad.cast("long").alias("neg"),
        )
        parts = rows if parts is None else parts.unionByName(rows)
    counted = parts.groupBy("kind", "calibrates", *FEATURES).agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    cells = [r.asDict() for r in counted.collect()]
    for c in cells:
        c["neg"] *= CHANCE[c["kind"]]
    models = {}
    for kind in KINDS:
        learn = [c for c in cells if c["kind"] == kind and not c["calibrates"]]
        if sum(c["pos"] for c in learn):
            trees = boost(sorted(learn, key=lambda c: tuple(c[f] for f in FEATURES)))
            limit = threshold([c for c in cells if c["kind"] == kind and c["calibrates"]], trees)
            if limit is not None:
                models[kind] = (trees, limit)
    return models


def with_spans(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text and any others) with tm_all_<kind>: base and added spans per kind."""
    proposed = with_proposals(with_base(docs))
    models = fit(proposed.select("doc_id", *(f"tm_wide_{k}" for k in KINDS)))
    columns: dict[str, Column] = {}
    based = proposed
    for kind in KINDS:
        base = f"transform(tm_{kind}, b -> struct(b.start as start, b.end as end))"
        if kind in models:
            trees, limit = models[kind]
            score = " + ".join(tree_sql(t) for t in trees)
            scored = (
                f"filter(transform(filter(tm_wide_{kind}, p -> p.sound and not p.taken), p -> struct({score} as score, p.start as start, "
                f"p.end as end)), p -> p.score >= {limit - 1e-6!r}D)"
            )
            based = based.withColumn(f"tm_more_{kind}", F.expr(scored))
            # Of overlapping accepted proposals the best stays, or of equal ones the first.
            better = "q.start < p.end and p.start < q.end and (q.score > p.score or q.score = p.score and struct(q.start, q.end) < struct(p.start, p.end))"
            best = f"filter(tm_more_{kind}, p -> not exists(tm_more_{kind}, q -> {better}))"
            columns[f"tm_all_{kind}"] = F.expr(f"array_sort(concat({base}, transform({best}, p -> struct(p.start as start, p.end as end))))")
        else:
            columns[f"tm_all_{kind}"] = F.expr(base)
    return based.withColumns(columns).drop(*(f"tm_{x}_{k}" for k in KINDS for x in ("wide", "more")))


def _listed(prefix: str) -> Column:
    """kind:start:end by kind, then start, comma-joined."""
    parts = [f"transform({prefix}{k}, s -> concat('{k}:', s.start, ':', s.end))" for k in KINDS]
    return F.expr(f"array_join(concat({', '.join(parts)}), ',')")


def find_personal_data(docs: DataFrame) -> DataFrame:
    """Counts and hash of the base spans and the list of all spans, per document (doc_id, text)."""
    found = with_spans(docs.select("doc_id", "text"))
    return found.select(
        "doc_id", *(F.size(f"tm_{k}").cast("long").alias(f"n_{k}") for k in KINDS),
        F.sha2(_listed("tm_"), 256).alias("base_sha256"), _listed("tm_all_").alias("spans"),
    )


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span replaced by its kind, as in <EMAIL>; all columns stay.

    Of overlapping spans the first gives the name and all are covered. Null text
    stays null. ``n_chars`` is the new length of changed texts where that column exists.
    Columns may have any names, the operator's own included.
    """
    docs, restored = shielded(docs)
    found = with_spans(docs)
    spans = "array_sort(concat(" + ", ".join(
        f"transform(tm_all_{k}, s -> struct(s.start as start, s.end as end, '<{k.upper()}>' as tag))" for k in KINDS
    ) + "))"
    redacted = found.withColumn("tm_spans", F.expr(spans)).withColumn("tm_new", F.expr(
        "if(size(tm_spans) = 0, text, aggregate(tm_spans, struct(0 as at, cast(array() as array<string>) as parts), "
        "(s, p) -> if(p.start < s.at, struct(greatest(s.at, p.end) as at, s.parts as parts), struct(p.end as at, "
        "concat(s.parts, array(substring(tm_text, s.at + 1, p.start - s.at), p.tag)) as parts)), "
        "s -> concat(array_join(s.parts, ''), substring(tm_text, s.at + 1))))"
    ))
    changed = F.expr("size(tm_spans) > 0")
    columns = [
        F.col("tm_new").alias(c) if c == "text"
        else F.when(changed, F.length("tm_new")).otherwise(F.col(c)).cast(docs.schema[c].dataType).alias(c) if c == "n_chars"
        else F.col(c)
        for c in docs.columns
    ]
    return restored(redacted.select(*columns))
