"""The two stream jobs, from records to metrics. A batch frame works as well."""

from pyspark.sql import DataFrame

from tagweave.functions.access_log import parse_lines
from tagweave.functions.behaviour import FLAGS, accepted_events
from tagweave.functions.user_agent import DEFAULT_RULES, AgentRules
from tagweave.operators.joins import DEFAULT_BOUND, Bound
from tagweave.operators.metrics import access_metrics, behaviour_counts, windowed_behaviour_counts
from tagweave.streaming.sources import values


def access_job(records: DataFrame, areas: DataFrame, agents: AgentRules = DEFAULT_RULES,
               bound: Bound = DEFAULT_BOUND) -> DataFrame:
    return access_metrics(parse_lines(values(records)), areas, agents, bound)


def behaviour_job(records: DataFrame) -> DataFrame:
    return behaviour_counts(accepted_events(values(records), only=("user_id", *FLAGS)))


def windowed_behaviour_job(records: DataFrame, window: str = "1 day", lateness: str = "10 minutes") -> DataFrame:
    parsed = accepted_events(values(records), only=("visit_time", *FLAGS))
    return windowed_behaviour_counts(parsed, window, lateness)
