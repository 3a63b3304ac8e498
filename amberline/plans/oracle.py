"""The same queries in plain SQL over the given tables, for cross-checking on another engine."""

from __future__ import annotations

# Transactions out of events, features, and scores, as common table expressions.
_TX = """
tx AS (
  SELECT CAST(event_id AS VARCHAR) AS transaction_id,
         CAST(user_id + 1000 AS INTEGER) AS user_id,
         value * 40.0 AS amount,
         strftime(ts, '%Y-%m-%dT%H:%M:%S') AS "timestamp",
         CASE user_id % 12 WHEN 0 THEN 'Lagos' WHEN 1 THEN 'Mumbai' WHEN 2 THEN 'Austin'
              WHEN 3 THEN 'Boston' ELSE 'Denver' END AS location,
         CASE event_type WHEN 'view' THEN 'Online Books' WHEN 'click' THEN 'Acme Ltd'
              ELSE 'Shop ' || event_type END AS merchant,
         CAST(CASE WHEN event_id % 33 = 0 THEN 1 ELSE 0 END AS INTEGER) AS is_fraud,
         ts AS kafka_timestamp
  FROM events
)"""

_FEATURES = """
feat AS (
  SELECT tx.*,
         CAST(hour(CAST("timestamp" AS TIMESTAMP)) AS INTEGER) AS hour,
         CAST(dayofweek(CAST("timestamp" AS TIMESTAMP)) + 1 AS INTEGER) AS day_of_week,
         CASE WHEN dayofweek(CAST("timestamp" AS TIMESTAMP)) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
         round(ln(1 + amount), 8) AS amount_log,
         CASE WHEN amount > 1000 THEN 1 ELSE 0 END AS is_high_amount,
         CASE WHEN amount < 10 THEN 1 ELSE 0 END AS is_low_amount,
         CASE WHEN location IN ('Lagos', 'Mumbai', 'Manila', 'Dhaka') THEN 1 ELSE 0 END AS location_risk,
         CAST(length(merchant) AS INTEGER) AS merchant_length,
         CASE WHEN contains(merchant, 'Online') THEN 1 ELSE 0 END AS is_online_merchant
  FROM tx
)"""

_RULES = """
judged AS (
  SELECT feat.*,
         amount > 5000 AS high_amount,
         hour BETWEEN 0 AND 5 AS late_night,
         location_risk = 1 AS risky_location,
         amount < 1 AS micro_amount,
         is_weekend = 1 AND amount > 2000 AS weekend_high_amount
  FROM feat
)"""

_SCORED = """
scored AS (
  SELECT judged.*,
         CASE WHEN high_amount OR late_night OR risky_location OR micro_amount OR weekend_high_amount
              THEN CAST(0.8 AS DOUBLE) ELSE CAST(0.1 AS DOUBLE) END AS fraud_probability,
         CASE WHEN high_amount OR late_night OR risky_location OR micro_amount OR weekend_high_amount
              THEN 1 ELSE 0 END AS is_fraud_predicted,
         'rule_based' AS prediction_method
  FROM judged
)"""

_PARSED_COLUMNS = (
    'transaction_id, user_id, amount, "timestamp", location, merchant, is_fraud, kafka_timestamp'
)
_SCORED_COLUMNS = (
    f"{_PARSED_COLUMNS}, hour, day_of_week, is_weekend, amount_log, is_high_amount, is_low_amount, "
    "location_risk, merchant_length, is_online_merchant, fraud_probability, is_fraud_predicted, "
    "prediction_method"
)
_RESULT_COLUMNS = (
    "transaction_id, user_id, amount, location, merchant, fraud_probability, is_fraud_predicted, "
    "is_fraud, prediction_method, kafka_timestamp AS processed_time"
)
_ALERT_COLUMNS = (
    "transaction_id, user_id, amount, location, merchant, fraud_probability, is_fraud, "
    "kafka_timestamp AS alert_time"
)
# Times in CSV and JSON files have milliseconds.
_TO_MILLIS = "date_trunc('millisecond', kafka_timestamp)"


def _on_tx(body: str) -> str:
    return f"WITH {_TX} {body}"


def _on_features(body: str) -> str:
    return f"WITH {_TX}, {_FEATURES} {body}"


def _on_rules(body: str) -> str:
    return f"WITH {_TX}, {_FEATURES}, {_RULES} {body}"


def _on_scored(body: str, more: str = "") -> str:
    return f"WITH {_TX}, {_FEATURES}, {_RULES}, {_SCORED}{more} {body}"


_SUM_ALL = "sum(amount)"
_SUM_FLAGGED = "sum(amount) FILTER (WHERE is_fraud_predicted = 1)"
_COUNTS = """
counts AS (
  SELECT count(*) AS total_transactions,
         count(*) FILTER (WHERE is_fraud_predicted = 1) AS fraud_detected,
         count(*) FILTER (WHERE is_fraud = 1) AS actual_fraud,
         count(*) FILTER (WHERE is_fraud_predicted = 1 AND is_fraud = 1) AS true_positives,
         {total} AS total_amount, {flagged} AS fraud_amount
  FROM scored
)""".format(total=_SUM_ALL, flagged=_SUM_FLAGGED)
_PRECISION = "CAST(true_positives AS DOUBLE) / nullif(fraud_detected, 0) AS precision"
_RECALL = "CAST(true_positives AS DOUBLE) / nullif(actual_fraud, 0) AS recall"


def _share(part: str, whole: str) -> str:
    return f"round(CAST({part} * 100 AS DOUBLE) / nullif({whole}, 0), 1)"


def _histogram(column: str, bins: int, by: str | None) -> str:
    key = f", {by}" if by else ""
    classes = f"CROSS JOIN (VALUES (0), (1)) AS classes({by})" if by else ""
    match = f"AND c.{by} = f.{by}" if by else ""

    def edge(index: str) -> str:
        return f"CASE WHEN {index} = {bins} THEN hi ELSE lo + {index} * ((hi - lo) / {bins}) END"

    return _on_scored(
        f"""SELECT f.bin, {edge('f.bin')} AS lower, {edge('(f.bin + 1)')} AS upper
                   {f', f.{by}' if by else ''}, coalesce(c.n, 0) AS n
            FROM frame f LEFT JOIN counted c ON c.bin = f.bin {match}""",
        f""",
span AS (SELECT min({column}) AS lo, max({column}) AS hi FROM scored),
placed AS (
  SELECT CAST(least(floor(({column} - lo) / ((hi - lo) / {bins})), {bins - 1}) AS INTEGER) AS g,
         {column} AS x, lo, hi{key} FROM scored, span
),
fixed AS (
  SELECT CAST(CASE WHEN x < {edge('g')} THEN g - 1
              WHEN g < {bins - 1} AND x >= {edge('(g + 1)')} THEN g + 1 ELSE g END AS INTEGER) AS bin{key}
  FROM placed
),
counted AS (SELECT bin{key}, count(*) AS n FROM fixed GROUP BY bin{key}),
frame AS (
  SELECT CAST(r.i AS INTEGER) AS bin{key}, lo, hi
  FROM range({bins}) AS r(i) CROSS JOIN span {classes}
)""",
    )


_TAMPERED = """
kinds AS (SELECT tx.*, CAST(transaction_id AS BIGINT) % 8 AS kind FROM tx),
tampered AS (
  SELECT CASE WHEN kind NOT IN (0, 1, 3, 4) THEN transaction_id END AS transaction_id,
         CASE WHEN kind NOT IN (0, 1, 2, 3, 4, 6) THEN user_id END AS user_id,
         CASE WHEN kind NOT IN (0, 1, 3, 4) THEN amount END AS amount,
         CASE WHEN kind NOT IN (0, 1, 3, 4) THEN "timestamp" END AS "timestamp",
         CASE WHEN kind NOT IN (0, 1, 3, 4) THEN location END AS location,
         CASE WHEN kind NOT IN (0, 1, 3, 4) THEN merchant END AS merchant,
         CASE WHEN kind NOT IN (0, 1, 3, 4, 5) THEN is_fraud END AS is_fraud,
         kafka_timestamp, kind
  FROM kinds
)"""
_PARSED_NAMES = [name.strip().strip('"') for name in _PARSED_COLUMNS.split(",")]

# Which kinds of tampered message fail each check.
_CHECKS = {
    "empty": "kind IN (1, 4)",
    "not_json": "kind IN (0, 3)",
    "wrong_type": "kind IN (2, 5)",
    "no_known_field": "FALSE",
    "missing_transaction_id": "FALSE",
    "missing_user_id": "kind = 6",
    "missing_amount": "FALSE",
    "missing_timestamp": "FALSE",
    "missing_location": "FALSE",
    "missing_merchant": "FALSE",
    "missing_is_fraud": "FALSE",
    "bad_timestamp": "FALSE",
    "negative_amount": "kind IN (6, 7) AND amount < 0",
    "bad_label": "FALSE",
}


def _union(selects: list[str]) -> str:
    return " UNION ALL ".join(selects)


# What the spoilt messages held.
_BODY = """to_json({'transaction_id': transaction_id, 'user_id': user_id, 'amount': amount, 'timestamp': "timestamp",
                    'location': location, 'merchant': merchant, 'is_fraud': is_fraud})"""
_QUARANTINE = f"""WITH {_TX},
        bodies AS (SELECT tx.*, CAST(transaction_id AS BIGINT) % 8 AS kind, CAST({_BODY} AS VARCHAR) AS body FROM tx)
        SELECT CASE kind WHEN 0 THEN 'not json ' || merchant WHEN 2 THEN regexp_replace(body, '"user_id":([0-9]+)', '"user_id":"\\1"')
                         WHEN 3 THEN left(body, length(body) - 1) WHEN 4 THEN ''
                         WHEN 5 THEN regexp_replace(body, '"is_fraud":[01]', '"is_fraud":true') END AS value,
               CASE WHEN kind IN (1, 4) THEN 'empty' WHEN kind IN (0, 3) THEN 'not_json'
                    ELSE 'wrong_type' END AS reason, kafka_timestamp
        FROM bodies WHERE kind NOT IN (6, 7)"""

_FLAGS = ("is_weekend", "is_high_amount", "is_low_amount", "location_risk", "is_online_merchant")


def _bayes(probability: str, method: str) -> str:
    """Scores of Bernoulli naive Bayes with add-one smoothing over the 0/1 features, fitted on all rows."""
    sums = ", ".join(f"sum({name}) AS s_{name}" for name in _FLAGS)
    log_odds = [
        f"{name} * ln((s_{name} + 1.0) / (n + 2.0)) + (1 - {name}) * ln(1 - (s_{name} + 1.0) / (n + 2.0))" for name in _FLAGS
    ]
    return _on_scored(
        f"""SELECT transaction_id, round({probability}, 6) AS fraud_probability,
                   CASE WHEN {probability} > 0.5 THEN 1 ELSE 0 END AS is_fraud_predicted, '{method}' AS prediction_method
            FROM chances""",
        f""",
fitted AS (SELECT is_fraud AS y, count(*) AS n, (SELECT count(*) FROM scored) AS total, {sums} FROM scored GROUP BY is_fraud),
weights AS (
  SELECT s.transaction_id, s.fraud_probability, y,
         exp(ln((n + 1.0) / (total + 2.0)) + {' + '.join(log_odds)}) AS w
  FROM scored s CROSS JOIN fitted
),
chances AS (
  SELECT transaction_id, fraud_probability, sum(w) FILTER (WHERE y = 1) / sum(w) AS p
  FROM weights GROUP BY transaction_id, fraud_probability
)""",
    )


_AMOUNT_BUCKETS = """
buckets(bucket_no, bucket, low, high) AS (
  VALUES (0, '$0-100', 0, 100), (1, '$100-500', 100, 500), (2, '$500-1K', 500, 1000),
         (3, '$1K-5K', 1000, 5000), (4, '$5K+', 5000, NULL), (5, 'other', NULL, NULL)
)"""

_RUNNING = _on_tx(
    f"""SELECT transactions, frauds, {_share('frauds', 'transactions')} AS fraud_rate{{extra}}
        FROM (SELECT row_number() OVER w AS transactions, CAST(sum(is_fraud) OVER w AS BIGINT) AS frauds
              FROM tx WINDOW w AS (ORDER BY kafka_timestamp, transaction_id
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
        WHERE transactions % 50 = 0{{tail}}"""
)

_RUNNING_WITH_FINAL = _RUNNING.format(
    extra=", FALSE AS is_final",
    tail=f" UNION ALL SELECT count(*), CAST(sum(is_fraud) AS BIGINT), "
    f"{_share('sum(is_fraud)', 'count(*)')}, TRUE FROM tx",
)

_PARSED = _on_tx(f"SELECT {_PARSED_COLUMNS} FROM tx")
_ALL_SCORED = _on_scored(f"SELECT {_SCORED_COLUMNS} FROM scored")
_RESULTS_MS = _on_scored(f"SELECT {_RESULT_COLUMNS} FROM scored").replace(
    "kafka_timestamp AS processed_time", f"{_TO_MILLIS} AS processed_time"
)
_ALERTS = _on_scored(f"SELECT {_ALERT_COLUMNS} FROM scored WHERE is_fraud_predicted = 1")
_ALERTS_MS = _ALERTS.replace("kafka_timestamp AS alert_time", f"{_TO_MILLIS} AS alert_time")
_TOP = _on_scored(
    """SELECT location, count(*) AS fraud_count FROM scored
       WHERE is_fraud_predicted = 1 AND location IS NOT NULL
       GROUP BY location ORDER BY fraud_count DESC, location LIMIT 10"""
)

ORACLE: dict[str, str] = {
    "parse_transactions": _PARSED,
    "messages_replay": _PARSED,
    "parse_tampered": f"WITH {_TX}, {_TAMPERED} SELECT {_PARSED_COLUMNS} FROM tampered",
    "features_time": _on_features("SELECT transaction_id, hour, day_of_week, is_weekend FROM feat"),
    "features_amount": _on_features(
        "SELECT transaction_id, amount_log, is_high_amount, is_low_amount FROM feat"
    ),
    "features_text": _on_features(
        "SELECT transaction_id, location_risk, merchant_length, is_online_merchant FROM feat"
    ),
    "features_risk_table": _on_scored(
        """SELECT transaction_id, location,
                  CASE WHEN location IN (SELECT location FROM scored GROUP BY location
                                         HAVING avg(is_fraud_predicted) > 0.5)
                       THEN 1 ELSE 0 END AS location_risk
           FROM scored"""
    ),
    "rule_hits": _on_rules(
        _union(
            [
                f"SELECT '{rule}' AS rule, count(*) FILTER (WHERE {rule}) AS hits FROM judged"
                for rule in (
                    "high_amount",
                    "late_night",
                    "risky_location",
                    "micro_amount",
                    "weekend_high_amount",
                )
            ]
        )
    ),
    "rules_fired": _on_rules(
        """SELECT transaction_id,
                  concat_ws('+', CASE WHEN high_amount THEN 'high_amount' END,
                            CASE WHEN late_night THEN 'late_night' END,
                            CASE WHEN risky_location THEN 'risky_location' END,
                            CASE WHEN micro_amount THEN 'micro_amount' END,
                            CASE WHEN weekend_high_amount THEN 'weekend_high_amount' END) AS rules_fired
           FROM judged"""
    ),
    "score_rules": _on_scored(
        "SELECT transaction_id, fraud_probability, is_fraud_predicted, prediction_method FROM scored"
    ),
    "predictions_view": _ALL_SCORED,
    "console_view": _on_scored(
        """SELECT transaction_id, user_id, amount, location, merchant, fraud_probability,
                  is_fraud_predicted, is_fraud FROM scored"""
    ),
    "results_view": _on_scored(f"SELECT {_RESULT_COLUMNS} FROM scored"),
    "alerts_view": _ALERTS,
    "legitimate_rows": _on_scored(
        "SELECT transaction_id, amount FROM scored WHERE is_fraud_predicted = 0"
    ),
    "alert_cards": _on_scored(
        """SELECT transaction_id, CAST(user_id AS VARCHAR) AS user_id,
                  CASE WHEN CAST(transaction_id AS BIGINT) % 3 <> 0 THEN round(amount, 2)
                       ELSE CAST(0 AS DOUBLE) END AS amount,
                  CASE WHEN CAST(transaction_id AS BIGINT) % 5 <> 0 THEN location ELSE 'N/A' END AS location,
                  merchant, fraud_probability
           FROM scored WHERE is_fraud_predicted = 1"""
    ),
    "coerce_results": _on_scored(
        """SELECT transaction_id,
                  CASE WHEN CAST(transaction_id AS BIGINT) % 9 <> 0 THEN amount END AS amount,
                  CASE WHEN CAST(transaction_id AS BIGINT) % 9 <> 1 THEN fraud_probability END
                    AS fraud_probability,
                  CASE WHEN CAST(transaction_id AS BIGINT) % 9 <> 2 THEN kafka_timestamp END
                    AS processed_time
           FROM scored"""
    ),
    "summary": _on_scored(
        f"""SELECT total_transactions, fraud_detected,
                   {_share('fraud_detected', 'total_transactions')} AS fraud_detected_pct,
                   actual_fraud, {_share('actual_fraud', 'total_transactions')} AS actual_fraud_pct,
                   true_positives, {_PRECISION}, {_RECALL},
                   round(total_amount, 2) AS total_amount, round(fraud_amount, 2) AS fraud_amount,
                   round(total_amount / total_transactions, 2) AS avg_amount,
                   round(fraud_amount / fraud_detected, 2) AS avg_fraud_amount
            FROM counts""",
        f",{_COUNTS}",
    ),
    "quality_metrics": _on_scored(
        f"SELECT fraud_detected, actual_fraud, true_positives, {_PRECISION}, {_RECALL} FROM counts",
        f",{_COUNTS}",
    ),
    "kpis": _on_scored(
        f"""SELECT total_transactions, fraud_detected,
                   {_share('fraud_detected', 'total_transactions')} AS fraud_rate,
                   round(total_amount, 0) AS total_amount FROM counts""",
        f",{_COUNTS}",
    ),
    "class_split": _on_scored(
        f"""SELECT is_fraud_predicted,
                   CASE is_fraud_predicted WHEN 1 THEN 'Fraudulent' ELSE 'Legitimate' END AS label,
                   count(*) AS transactions,
                   {_share('count(*)', '(SELECT count(*) FROM scored)')} AS share_pct
            FROM scored GROUP BY is_fraud_predicted"""
    ),
    "status_counts": _on_scored(
        """SELECT CASE WHEN is_fraud_predicted = 1 THEN 'FRAUD' ELSE 'LEGIT' END AS status,
                  count(*) AS transactions FROM scored GROUP BY 1"""
    ),
    "amount_histogram": _histogram("amount", 30, "is_fraud_predicted"),
    "probability_histogram": _histogram("fraud_probability", 20, None),
    "amount_buckets": _on_scored(
        """SELECT b.bucket_no, b.bucket,
                  count(*) FILTER (WHERE s.is_fraud_predicted = 0) AS legitimate,
                  count(*) FILTER (WHERE s.is_fraud_predicted = 1) AS fraudulent
           FROM buckets b LEFT JOIN scored s
             ON (s.amount >= b.low AND (b.high IS NULL OR s.amount < b.high))
             OR (b.bucket = 'other' AND (s.amount IS NULL OR s.amount < 0))
           GROUP BY b.bucket_no, b.bucket""",
        f",{_AMOUNT_BUCKETS}",
    ),
    "top_locations": _TOP,
    "top_locations_from_messages": _TOP,
    "recent_alerts": _on_scored(
        f"""SELECT {_ALERT_COLUMNS}, (SELECT count(*) FROM scored WHERE is_fraud_predicted = 1) AS total_alerts
            FROM scored WHERE is_fraud_predicted = 1
            ORDER BY kafka_timestamp DESC, transaction_id LIMIT 5"""
    ),
    "recent_alerts_web": _on_scored(
        """SELECT user_id, amount, location, fraud_probability FROM scored
           WHERE is_fraud_predicted = 1 ORDER BY kafka_timestamp DESC, transaction_id LIMIT 4"""
    ),
    "recent_transactions": _on_scored(
        """SELECT user_id, round(amount, 2) AS amount, location,
                  CASE WHEN is_fraud_predicted = 1 THEN 'FRAUD' ELSE 'LEGIT' END AS status
           FROM scored ORDER BY kafka_timestamp DESC, transaction_id LIMIT 8"""
    ),
    "running_fraud_rate": _RUNNING_WITH_FINAL,
    "results_roundtrip": _RESULTS_MS,
    "results_other_headers": _RESULTS_MS.replace(
        "is_fraud, prediction_method", "is_fraud, CASE WHEN CAST(transaction_id AS BIGINT) % 4 <> 1 THEN prediction_method END AS prediction_method"
    ),
    "alerts_roundtrip": _ALERTS_MS,
    "union_results": _on_scored(
        f"SELECT {_RESULT_COLUMNS} FROM scored".replace(
            "prediction_method", "CASE WHEN is_fraud = 0 THEN prediction_method END AS prediction_method"
        )
    ),
    "stream_score": _ALL_SCORED,
    "stream_deduplicated": _ALL_SCORED,
    "stream_results": _RESULTS_MS,
    "stream_alerts": _ALERTS_MS,
    "stream_separate_sinks": _on_scored(
        _union(
            [
                "SELECT 'predictions' AS sink, count(*) AS n_rows FROM scored",
                "SELECT 'results', count(*) FROM scored",
                "SELECT 'alerts', count(*) FROM scored WHERE is_fraud_predicted = 1",
            ]
        )
    ),
    "stream_running_rate": _RUNNING_WITH_FINAL,
    "stream_running_rate_shuffled": _RUNNING_WITH_FINAL,
    "separate_score": _ALL_SCORED,
    "separate_results": _RESULTS_MS,
    "separate_alerts": _ALERTS_MS,
    "compacted_predictions": f"{_ALL_SCORED} WHERE kafka_timestamp >= TIMESTAMP '2024-01-16'",
    "write_latency": _on_tx(
        """SELECT count(*) AS transactions, quantile_disc(us, 0.5) / 1e6 AS p50, quantile_disc(us, 0.95) / 1e6 AS p95,
                  quantile_disc(us, 0.99) / 1e6 AS p99, max(us) / 1e6 AS max
           FROM (SELECT epoch_us(TIMESTAMP '2024-02-01') - epoch_us(kafka_timestamp) AS us FROM tx)"""
    ),
    "throughput": _on_tx(
        """SELECT date_trunc('hour', kafka_timestamp) AS window_start,
                  date_trunc('hour', kafka_timestamp) + INTERVAL 1 HOUR AS window_end,
                  count(*) AS transactions FROM tx GROUP BY 1, 2"""
    ),
    "flag_rate_over_time": _on_scored(
        f"""SELECT date_trunc('hour', kafka_timestamp) AS window_start,
                   date_trunc('hour', kafka_timestamp) + INTERVAL 1 HOUR AS window_end,
                   count(*) AS transactions, CAST(sum(is_fraud_predicted) AS BIGINT) AS flagged,
                   {_share('sum(is_fraud_predicted)', 'count(*)')} AS flag_rate
            FROM scored GROUP BY 1, 2"""
    ),
    "schema_violations": f"WITH {_TX}, {_TAMPERED} "
    + _union(
        [
            f"""SELECT '{check}' AS "check", count(*) FILTER (WHERE {condition}) AS violations,
                       count(*) AS checked,
                       {_share(f'count(*) FILTER (WHERE {condition})', 'count(*)')} AS violation_pct
                FROM tampered"""
            for check, condition in _CHECKS.items()
        ]
    ),
    "quarantine": _QUARANTINE,
    # JSON keeps milliseconds, and leaves out a null value.
    "stream_quarantine": _QUARANTINE.replace(", kafka_timestamp\n", f", {_TO_MILLIS} AS kafka_timestamp\n"),
    "score_model": _bayes("CAST(p AS DOUBLE)", "model"),
    "score_ensemble": _bayes("0.7 * fraud_probability + (1 - 0.7) * p", "ensemble"),
    "null_profile": f"WITH {_TX}, {_TAMPERED} "
    + _union(
        [
            f"""SELECT '{name}' AS column_name, count(*) - count("{name}") AS null_count,
                       count(*) AS row_count,
                       {_share(f'(count(*) - count("{name}"))', 'count(*)')} AS null_pct
                FROM tampered"""
            for name in _PARSED_NAMES
        ]
    ),
    "freshness": _on_tx(
        """SELECT location, max(kafka_timestamp) AS newest,
                  CAST(floor(epoch(TIMESTAMP '2024-02-01') - epoch(max(kafka_timestamp))) AS BIGINT)
                    AS age_seconds
           FROM tx GROUP BY location"""
    ),
    "deduplicated": _PARSED,
}
# Figures from the states of batches are those of all rows.
ORACLE |= {f"state_{name}": ORACLE[name] for name in ("summary", "class_split", "amount_buckets", "top_locations")}
ORACLE["stream_intake"] = f"""WITH {_TX}, kinds AS (SELECT CAST(transaction_id AS BIGINT) % 8 AS kind FROM tx)
SELECT count(*) AS messages, count(*) FILTER (WHERE kind NOT IN (6, 7)) AS refused, count(*) FILTER (WHERE kind IN (6, 7)) AS scored FROM kinds"""


# A row is flagged when its score is above the threshold; the floor flags all.
_CURVE = """
counted AS (SELECT s, count(*) AS n, sum(is_fraud) AS y FROM judged_rows GROUP BY s UNION ALL SELECT CAST(-1 AS DOUBLE), 0, 0),
curve AS (
  SELECT s AS threshold, CAST(coalesce(sum(n) OVER above, 0) AS BIGINT) AS flagged,
         CAST(coalesce(sum(y) OVER above, 0) AS BIGINT) AS true_positives, CAST(sum(y) OVER () AS DOUBLE) AS frauds
  FROM counted WINDOW above AS (ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
judged_curve AS (
  SELECT threshold, flagged, true_positives, CAST(true_positives AS DOUBLE) / nullif(flagged, 0) AS precision,
         true_positives / frauds AS recall, CAST(2 * true_positives AS DOUBLE) / (flagged + frauds) AS f1
  FROM curve
)"""
_NOT_HELD = "NOT CAST('0x' || substr(md5(transaction_id), 1, 8) AS BIGINT) % 100 < 20"
ORACLE["amount_curve"] = f"""WITH {_TX}, judged_rows AS (SELECT amount AS s, is_fraud FROM tx WHERE {_NOT_HELD}), {_CURVE}
SELECT * FROM judged_curve"""
ORACLE["amount_threshold"] = f"""WITH {_TX}, judged_rows AS (SELECT amount AS s, is_fraud FROM tx), {_CURVE}
SELECT * FROM judged_curve ORDER BY f1 DESC, threshold DESC LIMIT 1"""
ORACLE["model_curve"] = f"""WITH chances AS ({ORACLE["score_model"]}),
judged_rows AS (SELECT fraud_probability AS s, CASE WHEN CAST(transaction_id AS BIGINT) % 33 = 0 THEN 1 ELSE 0 END AS is_fraud FROM chances), {_CURVE}
SELECT * FROM judged_curve"""

# Sketches of few values are exact.
ORACLE["waits_by_window"] = f"""WITH {_TX}, waits AS (
  SELECT date_trunc('hour', kafka_timestamp) AS window_start, epoch_us(TIMESTAMP '2024-02-01') - epoch_us(kafka_timestamp) AS us FROM tx)
SELECT window_start, count(*) AS transactions, quantile_disc(us, 0.5) / 1e6 AS p50, quantile_disc(us, 0.95) / 1e6 AS p95,
       quantile_disc(us, 0.99) / 1e6 AS p99, max(us) / 1e6 AS max FROM waits GROUP BY window_start"""
