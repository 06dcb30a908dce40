"""Personal data by weak supervision, in DataFrame and SQL functions only.

Candidate spans come from base rules (email, ip, card, phone) and from looser shapes. Voters on each candidate are a
regular expression (the base rule), gazetteers (top-level domains, calling codes, card issuers, given names), its
context (cue words before it) and its edges. Expectation-maximisation over the counts of vote patterns estimates how
reliable each voter is; its posterior trains a logistic classifier on the span's own features. Base spans always stay;
a looser one is added if the classifier accepts it and it meets no base span.

Each text is scanned once and only candidates are written; later steps read those. The driver sees counts of vote
and feature patterns alone, of which there are at most KINDS * 3 ** 4 * 2 * 5 * 4 * 4.

The patterns are the plain ones with possessive repeats and a look behind, which changes no match but never scans a
run of characters from each of its places: time grows with the text, whatever it holds. \\G lets a match begin where
the one before ended.
"""

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagweave.llm.tables import written

KINDS = ("email", "ip", "card", "phone", "id", "name")
BASE_KINDS = KINDS[:4]
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_AT, _DOT = r"\x20?[(\[]at[)\]]\x20?", r"(?:\.|\x20?[(\[]dot[)\]]\x20?)"
LOOSE = {
    "email": rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++{_AT}[A-Za-z0-9-]++(?:{_DOT}[A-Za-z0-9-]++)++",
    "phone": r"(?<![0-9+(])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
    "id": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "name": r"\b(?:Mr|Mrs|Ms|Dr|Herr|Frau|Mme)\.?\x20[A-Z][a-z]++(?:\x20[A-Z][a-z]++)?",
}
OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
# What a text must hold for a kind to be looked for at all.
NEEDS = {"email": "contains(text, '@')", "phone": "contains(text, '+')"}
# Gazetteers, as patterns on the match.
GAZETTEER = {
    "email": r"(?i)\.(?:com|org|net|edu|gov|info|io|eu|de|fr|es|it|uk|ch|at|nl)$",
    "ip": r"^(?!0*(?:0|127|255)\.)",
    "card": r"^(?:3[4-7]|4|5[1-5]|2[2-7]|6(?:011|4|5))",
    "phone": r"^\+?\D*(?:1|7|20|27|3[0-469]|4[0-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])",
    "id": r"^(?!000|666|9)",
    "name": r"\b(?:Anna|Ben|Carlos|Clara|David|Emma|Jean|John|Julia|Karl|Lena|Marie|Maria|Paul|Peter|Sarah|Thomas)\b",
}
CUES = {
    "email": "e-?mail|contact|write to|reach", "ip": r"\bip\b|address|host|server|login", "card": "card|visa|credit|pay",
    "phone": "phone|tel|call|mobile|fax", "id": r"ssn|social|\bid\b|tax", "name": "name|contact|dear|by|sincerely",
}
COUNTER_CUES = r"version|isbn|order|invoice|ref|serial|page|section|figure"
VOTERS = ("shape", "gazetteer", "context", "edges")
FEATURES = {"kind": len(KINDS), "digits": 5, "marks": 4, "cue": 2, "edge": 2, "looks": 3}
ABSTAIN = 2
BLOCK = 128


def literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def matches(text: str, pattern: str, need: str) -> Column:
    """start, end (code points), match, and up to 40 characters before and one after, of all matches of a column."""
    p = literal(pattern)
    return F.expr(f"""
        CASE WHEN {need} THEN regexp_extract_all({text}, {p}, 0) END""").alias("found"), F.expr(f"""
        CASE WHEN {need} THEN split({text}, {p}, -1) END""").alias("gaps")


def located(found: str, gaps: str) -> Column:
    """The spans of the matches, whose starts add up the gaps and matches before them.

    Added up in blocks of BLOCK matches, each from the sum of the blocks before it: an array grows by copying, so one
    that grew over all matches of a text would cost the square of their number.
    """
    kind = "array<struct<start: int, end: int, match: string, before: string, after: string>>"
    total = (f"aggregate(slice({found}, b * {BLOCK} + 1, {BLOCK}), 0, (n, m) -> n + length(m))"
             f" + aggregate(slice({gaps}, b * {BLOCK} + 1, least({BLOCK}, size({found}) - b * {BLOCK})), 0, (n, g) -> n + length(g))")
    blocks = f"sequence(0, (size({found}) - 1) div {BLOCK})"
    starts = f"""aggregate(transform({blocks}, b -> {total}), struct(0 AS at, cast(array() AS array<int>) AS starts),
        (a, n) -> struct(a.at + n AS at, concat(a.starts, array(a.at)) AS starts), a -> a.starts)"""
    block = f"""aggregate(
        sequence(s.b * {BLOCK} + 1, least((s.b + 1) * {BLOCK}, size({found}))),
        struct(s.at AS at, cast(array() AS {kind}) AS spans),
        (a, i) -> struct(
          a.at + length({gaps}[i - 1]) + length({found}[i - 1]) AS at,
          concat(a.spans, array(named_struct(
            'start', a.at + length({gaps}[i - 1]), 'end', a.at + length({gaps}[i - 1]) + length({found}[i - 1]),
            'match', {found}[i - 1], 'before', lower(right({gaps}[i - 1], 40)), 'after', left({gaps}[i], 1)))) AS spans),
        a -> a.spans)"""
    return F.expr(f"""
        CASE WHEN size({found}) > 0 THEN
          flatten(transform(zip_with({blocks}, {starts}, (b, at) -> struct(b, at)), s -> {block}))
        ELSE cast(array() AS {kind}) END""")


def valid(kind: str) -> str:
    """The base rule on x.match."""
    digits = "regexp_replace(x.match, '[^0-9]', '')"
    return {
        "email": "true",
        "ip": f"x.match RLIKE {literal(f'^{OCTET}' + rf'(?:[.]{OCTET})' + '{3}$')}",
        "card": f"length({digits}) BETWEEN 14 AND 19 AND luhn_check({digits})",
        "phone": f"length({digits}) BETWEEN 10 AND 15",
    }[kind]


def described(spans: str, kind: str, base: bool) -> str:
    """Votes (0 no, 1 yes, 2 abstains) and features of each span of an array column."""
    shape = valid(kind) if base else "false"
    digits = "length(regexp_replace(x.match, '[^0-9]', ''))"
    edge = r"(x.after = '' OR x.after RLIKE '[\\s.,;:!?)\\]]') AND (x.before = '' OR x.before RLIKE '[\\s.,;:(\\[<]$')"
    cue = f"x.before RLIKE {literal(CUES[kind])}"
    gazetteer = f"x.match RLIKE {literal(GAZETTEER[kind])}"
    # Shapes beyond the base rules are no evidence against a span, only none for it.
    vote = f"if({shape}, 1, 0)" if base else str(ABSTAIN)
    return f"""transform({spans}, x -> named_struct(
        'start', x.start, 'end', x.end, 'kind', {KINDS.index(kind)}, 'base', {shape},
        'shape', {vote}, 'gazetteer', if({gazetteer}, 1, {0 if kind in ("ip", "card", "id") else ABSTAIN}),
        'context', CASE WHEN {cue} THEN 1 WHEN x.before RLIKE {literal(COUNTER_CUES)} THEN 0 ELSE {ABSTAIN} END,
        'edges', if({edge}, 1, 0),
        'digits', cast(floor(4 * {digits} / length(x.match)) AS int),
        'marks', least(3, length(regexp_replace(x.match, '[A-Za-z0-9]', ''))),
        'cue', if({cue}, 1, 0), 'edge', if({edge}, 1, 0),
        'looks', if({gazetteer}, 1, 0) + if({shape}, 1, 0)))"""


def candidates(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id and the candidates of each document, those by base rules apart from looser ones."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), *keep)
    digit = rows.withColumn("has_digit", F.expr("text RLIKE '[0-9]'"))
    for name, pattern in [*BASE.items(), *((f"loose_{k}", p) for k, p in LOOSE.items())]:
        kind = name.removeprefix("loose_")
        need = NEEDS.get(name, "contains(text, 't') AND (contains(text, '(at)') OR contains(text, '[at]'))"
                         if name == "loose_email" else "true" if kind == "name" else "has_digit")
        found, gaps = matches("text", pattern, need)
        digit = digit.select("*", found.alias(f"{name}_found"), gaps.alias(f"{name}_gaps"))
    names = [*BASE, *(f"loose_{k}" for k in LOOSE)]
    spans = digit.select("doc_id", *keep, *(located(f"{n}_found", f"{n}_gaps").alias(n) for n in names))
    arrays = [described(n, n.removeprefix("loose_"), n in BASE) for n in names]
    return written(spans.select("doc_id", *keep, F.expr(f"concat({', '.join(arrays)})").alias("spans"))
                   .withColumn("_row", F.monotonically_increasing_id()), "pii-spans")


def reliabilities(patterns: list[tuple[int, tuple[int, ...], float]], rounds: int = 50) -> dict:
    """Posterior that a candidate is personal data, by kind and votes, from counts of patterns.

    Voters are taken as independent given the truth; each kind has a share of true ones of its own.
    """
    share = {kind: 0.5 for kind, _, _ in patterns}
    right = [{1: [0.3, 0.7], 0: [0.7, 0.3]} for _ in VOTERS]
    posterior = {}
    for _ in range(rounds):
        for kind, votes, _ in patterns:
            yes, no = math.log(share[kind]), math.log(1 - share[kind])
            for table, vote in zip(right, votes, strict=True):
                if vote != ABSTAIN:
                    yes, no = yes + math.log(table[vote][1]), no + math.log(table[vote][0])
            posterior[kind, votes] = 1 / (1 + math.exp(max(-500.0, min(500.0, no - yes))))
        for kind in share:
            own = [(posterior[k, v], n) for k, v, n in patterns if k == kind]
            share[kind] = (sum(p * n for p, n in own) + 1) / (sum(n for _, n in own) + 2)
        for i, table in enumerate(right):
            for truth in (0, 1):
                weights = [(v[i], n * (posterior[k, v] if truth else 1 - posterior[k, v])) for k, v, n in patterns
                           if v[i] != ABSTAIN]
                ones = (sum(w for vote, w in weights if vote == 1) + 7 * (0.3, 0.7)[truth]) / (
                    sum(w for _, w in weights) + 7)
                table[1][truth], table[0][truth] = ones, 1 - ones
    return posterior


def train(rows: list[tuple[tuple[int, ...], float, float]], rounds: int = 300, rate: float = 1.0) -> list[list[float]]:
    """Weights per feature and value, for rows of (feature values, weight, share of true ones)."""
    weights = [[0.0] * n for n in FEATURES.values()]
    total = sum(n for _, n, _ in rows) or 1.0
    squares = [[1e-6] * n for n in FEATURES.values()]
    for _ in range(rounds):
        slope = [[1e-4 * w for w in own] for own in weights]
        for values, n, p in rows:
            z = sum(own[v] for own, v in zip(weights, values, strict=True))
            error = n / total * (1 / (1 + math.exp(-max(-500.0, min(500.0, z)))) - p)
            for own, v in zip(slope, values, strict=True):
                own[v] += error
        for own, step, square in zip(weights, slope, squares, strict=True):
            for v, g in enumerate(step):
                square[v] += g * g
                own[v] -= rate * g / math.sqrt(square[v])
    return weights


def classifier(found: DataFrame) -> list[list[float]]:
    each = found.select(F.explode("spans").alias("s")).select("s.*")
    counts = each.groupBy(*FEATURES, *VOTERS).count().collect()
    votes: dict = {}
    for r in counts:
        key = r["kind"], tuple(r[v] for v in VOTERS)
        votes[key] = votes.get(key, 0) + r["count"]
    posterior = reliabilities([(k, v, float(n)) for (k, v), n in sorted(votes.items())])
    sums: dict = {}
    for r in counts:
        n, p = sums.get(values := tuple(r[f] for f in FEATURES), (0.0, 0.0))
        sums[values] = n + r["count"], p + r["count"] * posterior[r["kind"], tuple(r[v] for v in VOTERS)]
    return train([(values, n, p / n) for values, (n, p) in sorted(sums.items())])


def joined(spans: str) -> str:
    names = ", ".join(map(repr, KINDS))
    return (f"array_join(transform(array_sort(transform({spans}, x -> struct(x.start AS start, x.kind AS kind, "
            f"x.end AS end))), x -> concat(element_at(array({names}), x.kind + 1), ':', x.start, ':', x.end)), ',')")


def personal_data(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256 and spans of each row.

    Null or empty text: no spans, the checksum of the empty text. Repeated rows: each its own result. Empty table: no
    rows. Columns other than doc_id and text are not read, but for those named in `keep`.
    """
    found = candidates(docs, keep)
    weights = classifier(found)
    terms = " + ".join(f"element_at(array({', '.join(f'{w!r}D' for w in own)}), x.{name} + 1)"
                       for name, own in zip(FEATURES, weights, strict=True))
    each = found.select("_row", F.explode("spans").alias("x")).where(f"x.base OR {terms} > 0").select("_row", "x.*")
    # An added span must not overlap a base one: the furthest end among those that start before, the next start after.
    # Both frames grow from the first row: Spark works out one that ends at the last row anew for each row.
    own, earlier = Window.partitionBy("_row"), (Window.unboundedPreceding, -1)
    before = F.max(F.expr("if(base, end, NULL)")).over(own.orderBy("start", F.desc("base")).rowsBetween(*earlier))
    after = F.min(F.expr("if(base, start, NULL)")).over(own.orderBy(F.desc("start"), "base").rowsBetween(*earlier))
    each = each.withColumn("_before", before).withColumn("_after", after)
    kept = each.where("base OR (coalesce(_before <= start, true) AND coalesce(_after >= end, true))")
    counts = [F.count_if(F.col("base") & (F.col("kind") == i)).alias(f"n_{k}") for i, k in enumerate(BASE_KINDS)]
    span = F.struct("start", "kind", "end")
    lists = kept.groupBy("_row").agg(*counts, F.collect_list(F.when(F.col("base"), span)).alias("base"),
                                     F.collect_list(span).alias("spans"))
    none = [F.coalesce(F.col(f"n_{k}"), F.lit(0)).cast("long").alias(f"n_{k}") for k in BASE_KINDS]
    base, spans = (F.coalesce(F.expr(joined(n)), F.lit("")) for n in ("base", "spans"))
    return found.select("_row", "doc_id", *keep).join(lists, "_row", "left").select(
        "doc_id", *none, F.sha2(base.cast("binary"), 256).alias("base_sha256"), spans.alias("spans"), *keep)


query = personal_data
