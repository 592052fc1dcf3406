"""Streaming query: session features maintained by Structured Streaming."""

from __future__ import annotations

import uuid

from ..session import ensure_checkpoint_dir
from ..streaming import telemetry as ST
from .q_integration import AVG_DIGITS
from .registry import query, rounded, sql_rounded
from .sqlfrag import dtext, noct, sv
from .standins import raw_sources, standin_ctes

_ROUND = ["xbox_total_duration_min", "xbox_mean_session_min"]
_D = sv("duration")
STREAM_SQL = "WITH " + standin_ctes(["xbox"]) + f"""
SELECT pid, count({_D}) AS xbox_total_sessions, COALESCE(sum({_D}), 0.0) AS xbox_total_duration_min,
  avg({_D}) AS xbox_mean_session_min, max({_D}) AS xbox_max_session_min,
  count(DISTINCT {dtext('title_id')}) AS xbox_unique_games,
  CAST(count_if({noct('session_start')}) AS BIGINT) AS xbox_nocturnal_sessions
FROM src_xbox GROUP BY pid"""


@query("session_features_stream", sql_rounded(STREAM_SQL, _ROUND, AVG_DIGITS))
def session_features_stream(spark, sf_dir):
    """A8 as a stream: the xbox stand-in rows land as CSV files in the shared
    folder, a Structured Streaming query reads them one file per micro-batch
    and keeps per-person state; the final state equals the batch features."""
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stream-{uuid.uuid4().hex}"
    src = raw_sources(spark, sf_dir, ["xbox"])["xbox"]
    src.repartition(4).write.option("header", True).csv(f"{base}/in")
    out = ST.run_to_table(spark, f"{base}/in", f"{base}/out", f"{base}/ckpt", "xbox", max_files_per_batch=1)
    return rounded(out, _ROUND, AVG_DIGITS)
