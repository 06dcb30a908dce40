"""Tag jobs: what each category matches, and the run from rules to stored tags."""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from tagweave.functions import tag_sets, text
from tagweave.operators import rules as rule_ops
from tagweave.operators.joins import lookup_join
from tagweave.operators.matching import attach_equal, attach_range, attach_ranges
from tagweave.operators.merging import collapse, merge_into_store, merge_tags, stored_text
from tagweave.operators.rules import RuleTree
from tagweave.operators.statistics import nth_most_frequent, recency_and_favourite, recency_days
from tagweave.sources.spec import SourceSpec
from tagweave.sources.store import VersionedTable

Reader = Callable[[SourceSpec], DataFrame]
Statistic = Callable[[DataFrame], DataFrame]

# What a job matches: the rule text itself, a number range or a date range.
EQUAL, NUMBERS, DATES = "equal", "numbers", "dates"
# Statistics computed per entity before matching.
RECENCY, FAVOURITE = "recency", "favourite"


@dataclass(frozen=True)
class TagJob:
    tag_id: int
    name: str
    key: str
    field: str
    match: str = EQUAL
    how: str = "left"
    # One of the kinds above, or the caller's own: from the source to one row an entity with key and field.
    statistic: str | Statistic | None = None

    def __post_init__(self):
        if self.match not in (EQUAL, NUMBERS, DATES):
            raise ValueError(f"unknown match: {self.match}")
        if not callable(self.statistic) and self.statistic not in (None, RECENCY, FAVOURITE):
            raise ValueError(f"unknown statistic: {self.statistic}")
        if self.how not in ("left", "inner"):
            raise ValueError(f"unknown way of joining: {self.how}")

    @property
    def attribute(self) -> str:
        """Column the rules are matched against, after the statistic."""
        return "days" if self.statistic == RECENCY else self.field

    @property
    def column(self) -> str:
        return f"tag_{self.tag_id}"


# Category ids with entity key, field and way of matching.
JOBS = {job.tag_id: job for job in (
    TagJob(4, "gender", "id", "gender", how="inner"),
    TagJob(7, "job", "id", "job"),
    TagJob(14, "age band", "id", "birthday", match=DATES, how="inner"),
    TagJob(23, "consumption cycle", "memberid", "finishtime", match=NUMBERS, statistic=RECENCY),
    TagJob(30, "payment method", "memberid", "paymentcode", statistic=FAVOURITE),
    TagJob(62, "political status", "id", "politicalface"),
    TagJob(66, "marital status", "id", "marriage"),
)}


@dataclass(frozen=True)
class RunOptions:
    """`as_of` is the day recency counts to; `rank` the favourite's place, 1 the top.

    `keyed_store`: the caller knows that the stored tags have one row a user (see `merging`); single jobs use it.
    """

    as_of: str | None = None
    rank: int = 1
    drop_stale: bool = False
    keyed_store: bool = False

    def __post_init__(self):
        if self.rank < 1:
            raise ValueError("rank counts from 1")

    def day(self) -> str:
        if self.as_of is None:
            raise ValueError("as_of is required for recency tags")
        return self.as_of


def _statistics(source: DataFrame, jobs: list[TagJob], options: RunOptions) -> DataFrame:
    """One row per entity with the statistics of all given jobs on this source."""
    if callable(jobs[0].statistic):
        return jobs[0].statistic(source)
    by_kind = {job.statistic: job for job in jobs}
    recency, favourite = by_kind.get(RECENCY), by_kind.get(FAVOURITE)
    if recency and favourite:
        return recency_and_favourite(source, recency.key, recency.field, favourite.field, options.day())
    if recency:
        return recency_days(source, recency.key, recency.field, options.day())
    if favourite:
        return nth_most_frequent(source, favourite.key, favourite.field, options.rank)
    return source


def _attach(df: DataFrame, job: TagJob, tree: RuleTree, how: str) -> DataFrame:
    rules = tree.children(job.tag_id)
    attribute = F.col(job.attribute)
    if job.match == EQUAL:
        return attach_equal(df, attribute, rules, job.column, how, tree.bound, small=tree.small)
    if job.match == DATES:
        day = text.day_number(text.compact_date(text.strip_dashes(attribute.cast("string"))))
        return attach_range(df, day, rule_ops.date_ranges(rules), job.column, how, tree.bound, tree.small)
    return attach_range(df, attribute, rule_ops.number_ranges(rules), job.column, how, tree.bound, tree.small)


def attach(df: DataFrame, job: TagJob, tree: RuleTree) -> DataFrame:
    """Add the job's column as the array of all tags a row gets; the rows stay as many as they are."""
    if job.match == EQUAL:
        tagged = _attach(df, job, tree, "left")
        return tagged.withColumn(job.column, F.array_compact(F.array(job.column)))
    attribute, ranges = F.col(job.attribute), rule_ops.number_ranges
    if job.match == DATES:
        attribute, ranges = text.day_number(text.compact_date(text.strip_dashes(attribute.cast("string")))), rule_ops.date_ranges
    return attach_ranges(df, attribute, ranges(tree.children(job.tag_id)), job.column, tree.bound, tree.small)


def compute(job: TagJob, source: DataFrame, tree: RuleTree, options: RunOptions = RunOptions()) -> DataFrame:
    """(userId, tagsId): every tag each entity gets from one job."""
    entities = _statistics(source, [job], options) if job.statistic else source
    tagged = _attach(entities, job, tree, job.how)
    return tagged.select(F.col(job.key).alias("userId"), F.col(job.column).alias("tagsId"))


def run_job(job: TagJob, tree: RuleTree, read: Reader, stored: DataFrame | None,
            options: RunOptions = RunOptions()) -> DataFrame:
    """One job up to the merged tags of the users it saw; no store means no merge."""
    new = compute(job, read(tree.source_spec(job.tag_id)), tree, options)
    if stored is None:
        return collapse(new)
    category = tree.tag_ids(job.tag_id) if tree.small else tree.children(job.tag_id)
    return merge_tags(new, stored, category, options.drop_stale, tree.bound, options.keyed_store)


def run_jobs_in_turn(jobs: list[TagJob], tree: RuleTree, read: Reader, stored: DataFrame,
                     options: RunOptions = RunOptions()) -> DataFrame:
    """The store after each job has merged into it, one after the other.

    Shuffles the store once per job; `run_jobs` gives the same rows with one shuffle.
    """
    for job in jobs:
        if not tree.small:
            stored = run_jobs([job], tree, read, stored, options)
            continue
        new = collapse(compute(job, read(tree.source_spec(job.tag_id)), tree, options))
        stored = merge_into_store(new, stored, tree.tag_ids(job.tag_id), options.drop_stale)
    return stored


def _source_groups(jobs: list[TagJob], tree: RuleTree, rank: int) -> list[tuple[SourceSpec, list[TagJob]]]:
    """Jobs that can share one scan: same source and key, and each statistic at most once."""
    groups: dict = {}
    for job in jobs:
        spec = tree.source_spec(job.tag_id)
        source = (spec.in_type, spec.nodes, spec.index, job.key)
        if job.statistic is None:
            place = (*source, "rows")
        elif rank == 1 and not callable(job.statistic):
            place = (*source, "statistics")
            if any(member.statistic == job.statistic for member in groups.get(place, (spec, []))[1]):
                place = (*source, job.tag_id)
        else:
            place = (*source, job.tag_id)
        known, members = groups.get(place, (spec, []))
        groups[place] = (known.with_fields(spec.fields), [*members, job])
    return list(groups.values())


def run_jobs(jobs: list[TagJob], tree: RuleTree, read: Reader, stored: DataFrame,
             options: RunOptions = RunOptions()) -> DataFrame:
    """The store after all jobs, in one pass.

    Categories hold different tag ids, so their merges do not affect each other and
    the order of jobs is free. Jobs on one source share its scan. All new tags and
    the stored tags then meet in ONE shuffle by user, in which merge and upsert are
    a single aggregate; in turn, every job would shuffle and rewrite the store.
    """
    texts = F.array().cast("array<string>")
    numbers = F.array().cast("array<int>")
    user_type = stored.schema["userId"].dataType
    rows = stored.select("userId", texts.alias("found"), numbers.alias("touched"),
                         F.col("tagsId").alias("old"), F.lit(True).alias("kept"))
    for spec, members in _source_groups(jobs, tree, options.rank):
        tagged = tagged_rows(_statistics(read(spec), members, options), members, tree, options)
        rows = rows.unionByName(tagged.select(
            F.col("userId").cast(user_type).alias("userId"), "found", "touched",
            F.lit(None).cast("string").alias("old"), F.lit(False).alias("kept")))

    # Sets, not lists: copies of a user's rows collapse on the map side already.
    per_user = rows.where(F.col("userId").isNotNull()).groupBy("userId").agg(
        F.array_distinct(F.flatten(F.collect_set("found"))).alias("found"),
        F.array_distinct(F.flatten(F.collect_set("touched"))).alias("touched"),
        stored_text(F.col("old"), F.sum(F.col("kept").cast("int"))).alias("old"),
        F.max("kept").alias("kept"))
    per_user = per_user.where(F.col("kept") | (F.size("found") > 0))
    with_others = _drop_touched(per_user, jobs, tree)
    merged = with_others.withColumn("merged", F.concat("found", F.coalesce("others", texts)))
    tags = F.when(F.size("touched") == 0, F.col("old")).otherwise(tag_sets.filled(F.col("merged")))
    return merged.select("userId", tags.alias("tagsId"))


def tagged_rows(entities: DataFrame, jobs: list[TagJob], tree: RuleTree, options: RunOptions) -> DataFrame:
    """(userId, found, touched) of each row: the tags of all jobs, and the categories they clear."""
    tagged = entities
    for job in jobs:
        tagged = attach(tagged, job, tree)
    # Equality rules of one code may be several; a range match never makes more rows.
    found = F.flatten(F.array(*[job.column for job in jobs]))
    touched = F.array_compact(F.array(*[_touched(job, options.drop_stale) for job in jobs]))
    return tagged.select(F.col(jobs[0].key).alias("userId"), found.alias("found"), touched.alias("touched"))


def _touched(job: TagJob, drop_stale: bool):
    """The category a row clears in the stored tags, null for none.

    With `drop_stale` an entity a left match has seen clears it without a new tag too.
    """
    if drop_stale and job.how == "left":
        return F.lit(job.tag_id)
    return F.when(F.size(job.column) > 0, job.tag_id)


def _drop_touched(per_user: DataFrame, jobs: list[TagJob], tree: RuleTree) -> DataFrame:
    """Add `others`: the old tags outside the touched categories."""
    if tree.small:
        none = F.array().cast("array<string>")
        removed = [
            F.when(F.array_contains("touched", job.tag_id), F.split(F.lit(",".join(tree.tag_ids(job.tag_id))), ","))
            .otherwise(none) for job in jobs]
        return per_user.withColumn("others", F.array_except(tag_sets.to_set(F.col("old")), F.concat(*removed)))

    # Categories too large for literals: each old tag looks up its own. The users'
    # other columns travel along, so that `per_user` is evaluated once.
    single = per_user.select("*", F.explode_outer(tag_sets.to_set(F.col("old"))).alias("tag"))
    parents = tree.rules.select(F.col("id").cast("string").alias("tag"), F.col("pid").alias("_category"))
    placed = lookup_join(single, parents, ["tag"], "left", small=False)
    cleared = F.coalesce(F.array_contains("touched", F.col("_category")), F.lit(False))
    return placed.groupBy("userId").agg(
        F.any_value("found").alias("found"), F.any_value("touched").alias("touched"),
        F.any_value("old").alias("old"), F.collect_set(F.when(~cleared, F.col("tag"))).alias("others"))


def tag_store_run(jobs: list[TagJob], tree: RuleTree, read: Reader, store: VersionedTable,
                  options: RunOptions = RunOptions()) -> int:
    """Run the jobs against a tag store and commit its next version."""
    if store.exists():
        stored = store.read()
    else:
        # First run: an empty store with the type of the first job's key.
        first = read(tree.source_spec(jobs[0].tag_id)).select(F.col(jobs[0].key).alias("userId"))
        stored = first.where(F.lit(False)).select("userId", F.lit(None).cast("string").alias("tagsId"))
    return store.write(run_jobs(jobs, tree, read, stored, options))
