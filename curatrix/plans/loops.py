"""The repair loop over attempts that events stand for; the oracle walks it row by row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curatrix.plans.base import Tables, query
from curatrix.streaming.repair import Limits, repair_loop

LIMITS = Limits(patience_s=4 * 86_400.0)
_PATIENCE = int(1000 * LIMITS.patience_s)


def attempts(t: Tables) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    owner = F.element_at(F.array(*map(F.lit, ("ORACLE", "INFRA", "KERNEL", "TEACHER"))), k % 4 + 1)
    return t.events.select(
        F.col("user_id").alias("job"), (k % 3).alias("candidate"), F.col("event_id").alias("seq"), F.col("ts").cast("timestamp").alias("ts"), (k % 10 == 0).alias("ok"), (k % 3 != 0).alias("compiled"),
        owner.alias("owner"), F.concat(F.lit("v"), (k % 5).cast("string")).alias("version"),
    )


@query(f"""WITH RECURSIVE a AS (SELECT user_id AS job, k % 3 AS candidate, event_id AS seq, epoch_us(ts) // 1000 AS ms, k % 10 = 0 AS ok, CASE WHEN k % 3 <> 0 THEN 'v' || (k % 5) END AS version, k % 4 < 2 AS outside,
    row_number() OVER (PARTITION BY user_id, k % 3 ORDER BY event_id) AS n FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events)),
w AS (SELECT job, candidate, 0::BIGINT AS n, NULL::BIGINT AS seq, 0::BIGINT AS ms, 'open' AS action, 0 AS repairs, 0 AS retries, 0::BIGINT AS due, []::VARCHAR[] AS banked FROM (SELECT DISTINCT job, candidate FROM a)
  UNION ALL
  SELECT job, candidate, n, CASE WHEN lost THEN NULL ELSE seq END, CASE WHEN lost THEN due + {_PATIENCE} ELSE ms END, CASE WHEN lost THEN 'lost' WHEN ok THEN 'success' WHEN outside THEN CASE WHEN retries >= {LIMITS.retries} THEN 'blocked' ELSE 'retry' END WHEN repairs >= {LIMITS.repairs} THEN 'abandoned' ELSE 'repair' END,
    repairs + CASE WHEN NOT lost AND NOT ok AND NOT outside AND repairs < {LIMITS.repairs} THEN 1 ELSE 0 END, retries + CASE WHEN NOT lost AND NOT ok AND outside AND retries < {LIMITS.retries} THEN 1 ELSE 0 END,
    CASE WHEN NOT lost AND NOT ok AND outside AND retries < {LIMITS.retries} THEN ms + CASE retries WHEN 0 THEN 5000 ELSE 20000 END ELSE due END, CASE WHEN lost OR version IS NULL OR list_contains(banked, version) THEN banked ELSE list_append(banked, version) END
  FROM (SELECT w.job, w.candidate, a.n, a.seq, a.ms, a.ok, a.outside, a.version, w.repairs, w.retries, w.due, w.banked, w.action = 'retry' AND a.ms > w.due + {_PATIENCE} AS lost FROM w JOIN a ON a.job = w.job AND a.candidate = w.candidate AND a.n = w.n + 1 WHERE w.action IN ('open', 'repair', 'retry'))),
late AS (SELECT w.* FROM w WHERE action = 'retry' AND n = (SELECT max(n) FROM a WHERE a.job = w.job AND a.candidate = w.candidate) AND due + {_PATIENCE} < (SELECT max(ms) FROM a) - 600000)
SELECT job, candidate, seq, ms, action, repairs, retries, CASE WHEN action = 'retry' THEN CASE retries WHEN 1 THEN 5.0 ELSE 20.0 END ELSE 0.0 END::DOUBLE AS wait_s, len(banked) AS banked FROM w WHERE n > 0
UNION ALL SELECT job, candidate, NULL, due + {_PATIENCE}, 'lost', repairs, retries, 0.0, len(banked) FROM late""")
def repair_steps(t: Tables) -> DataFrame:
    """What each attempt of a candidate leads to: repair, another try after a wait, or its end."""
    return repair_loop(attempts(t), LIMITS).withColumn("ms", F.unix_millis("at")).drop("at")
