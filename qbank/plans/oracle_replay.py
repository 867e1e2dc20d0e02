"""SQL oracles of the jobs over recorded replies."""

from __future__ import annotations

from qbank.plans.oracle_sql import ORACLES

CTE = """
sys AS (SELECT conv_id, arg_min(text, turn) AS s FROM conversations WHERE role = 'system' GROUP BY conv_id),
req AS (SELECT u.conv_id, u.turn, u.text AS ask, coalesce(sys.s, '') AS s, a.text AS own_reply
        FROM conversations u LEFT JOIN sys USING (conv_id)
        LEFT JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
        WHERE u.role = 'user'),
rep AS (SELECT ask, s, arg_max(own_reply, (conv_id, turn)) AS response FROM req
        WHERE own_reply IS NOT NULL GROUP BY ask, s),
got AS (SELECT req.*, rep.response FROM req LEFT JOIN rep USING (ask, s))"""


def recorded_requests() -> str:
    return f"""WITH {CTE}
SELECT conv_id, turn, md5(ask) AS prompt_md5, count(*) OVER (PARTITION BY ask, s) AS n_same FROM req"""


def recorded_replies() -> str:
    return f"""WITH {CTE}
SELECT conv_id, turn, CASE WHEN response IS NULL THEN 'missing' ELSE 'ok' END AS status,
       md5(response) AS response_md5 FROM got"""


def recorded_accuracy() -> str:
    return f"""WITH {CTE},
per AS (SELECT ask, s, conv_id, max(turn) AS turn, arg_max(own_reply, turn) AS reply FROM req
        WHERE own_reply IS NOT NULL GROUP BY ask, s, conv_id),
o AS (SELECT req.conv_id, req.turn, any_value(req.own_reply) AS own_reply,
             arg_max(per.reply, (per.conv_id, per.turn)) AS response
      FROM req LEFT JOIN per ON per.ask = req.ask AND per.s = req.s AND per.conv_id <> req.conv_id
      GROUP BY req.conv_id, req.turn),
c AS (SELECT count(*) AS n_requests, count(response) AS n_succeeded,
             CAST(coalesce(sum(CAST(response = own_reply AS BIGINT)), 0) AS BIGINT) AS n_correct FROM o)
SELECT *, CASE WHEN n_succeeded > 0 THEN CAST(n_correct AS DOUBLE) * 100.0 / CAST(n_succeeded AS DOUBLE) END AS accuracy_pct
FROM c"""


def cached_replies() -> str:
    return f"SELECT conv_id, turn, replace(status, 'missing', 'error') AS status, response_md5 FROM ({recorded_replies()})"


ORACLES.update({"recorded_requests": recorded_requests, "recorded_replies": recorded_replies,
                "recorded_accuracy": recorded_accuracy, "cached_replies": cached_replies})
