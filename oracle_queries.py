"""The registered queries in DuckDB SQL, over the driver's tables."""

from driver_tables import FLIGHTS_SQL, LOG_SQL, MIN_FLIGHTS, PLANTED_SQL, PRICES_SQL

CLEAN_SQL = """
    SELECT ARR_DELAY::FLOAT AS ARR_DELAY, DEP_DELAY::FLOAT AS DEP_DELAY,
        OP_UNIQUE_CARRIER, ORIGIN, ORIGIN_CITY_NAME, DEST,
        coalesce(CARRIER_DELAY, 0) AS CARRIER_DELAY,
        coalesce(WEATHER_DELAY, 0) AS WEATHER_DELAY,
        coalesce(NAS_DELAY, 0) AS NAS_DELAY,
        coalesce(SECURITY_DELAY, 0) AS SECURITY_DELAY,
        coalesce(LATE_AIRCRAFT_DELAY, 0) AS LATE_AIRCRAFT_DELAY,
        DISTANCE::FLOAT AS DISTANCE, FL_DATE, flight_id
    FROM flights
    WHERE CANCELLED = 0 AND ARR_DELAY IS NOT NULL AND DEP_DELAY IS NOT NULL
        AND OP_UNIQUE_CARRIER IS NOT NULL AND ORIGIN IS NOT NULL AND DEST IS NOT NULL
"""

LINES_SQL = r"""
    SELECT run_id, line_no, line FROM log_table
    WHERE trim(line) <> ''
        AND NOT (contains(line, '[Stage ') AND (contains(line, '====>') OR contains(line, '=>')))
"""

LABELLED_SQL = """
    SELECT *, CASE WHEN ARR_DELAY > 15 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS IS_DELAYED
    FROM clean WHERE ARR_DELAY IS NOT NULL
"""


def _hash(seed: int) -> str:
    text = f"concat_ws('|', '{seed}', flight_id::VARCHAR, FL_DATE, OP_UNIQUE_CARRIER, ORIGIN, DEST)"
    return f"(('0x' || substr(md5({text}), 1, 15))::BIGINT)"


SAMPLED = f"{_hash(42)} < {round(0.05 * 2**60)}"
IN_TRAIN = f"{_hash(43)} < {round(0.7 * 2**60)}"
HAS_FEATURES = "OP_UNIQUE_CARRIER IS NOT NULL AND DISTANCE IS NOT NULL AND FL_DATE IS NOT NULL"

_FLIGHTS = f"WITH flights AS ({FLIGHTS_SQL})"
_CLEAN = f"{_FLIGHTS}, clean AS ({CLEAN_SQL})"
_LABELLED = f"{_CLEAN}, labelled AS ({LABELLED_SQL})"
_ML = f"{_LABELLED}, ml AS (SELECT * FROM labelled WHERE {SAMPLED} AND {HAS_FEATURES})"
_PLANTED = _ML.replace(FLIGHTS_SQL, PLANTED_SQL)
_LINES = f"WITH log_table AS ({LOG_SQL}), lines AS ({LINES_SQL})"

_CAUSE_SUMS = """
    SELECT sum(LATE_AIRCRAFT_DELAY) AS Late_Aircraft_Error, sum(CARRIER_DELAY) AS Carrier_Error,
        sum(NAS_DELAY) AS NAS_Error, sum(WEATHER_DELAY) AS Weather_Error,
        sum(SECURITY_DELAY) AS Security_Error
"""

_ORIGINS = """
    SELECT ORIGIN, ORIGIN_CITY_NAME, count(*) AS Total_Flights,
        round(avg(DEP_DELAY::DOUBLE), 2) AS Avg_Dep_Delay_Minutes
    FROM {table} WHERE DEP_DELAY IS NOT NULL GROUP BY ALL
"""

_TOP = """
    SELECT * FROM ({origins}) WHERE Total_Flights > {min_flights}
    ORDER BY Avg_Dep_Delay_Minutes DESC, ORIGIN, ORIGIN_CITY_NAME LIMIT {k}
"""

_MONTHS = """
    SELECT month(try_cast(FL_DATE AS DATE))::INTEGER AS Flight_Month, count(*) AS Total_Flights,
        round(avg(ARR_DELAY::DOUBLE), 2) AS Avg_Arr_Delay_Minutes
    FROM {table} WHERE ARR_DELAY IS NOT NULL GROUP BY 1
"""

_TIMING = r"'--> \[Time\] Step (\d) \(.*?\) took: ([\d.]+)s'"


def _top(table: str, k: int) -> str:
    return _TOP.format(origins=_ORIGINS.format(table=table), min_flights=MIN_FLIGHTS, k=k)


def _thousands(column: str) -> str:
    return f"format('{{:,}}', trunc({column})::BIGINT)"


def _causes_text() -> str:
    names = {
        "Late_Aircraft_Error": "Late Aircraft", "Carrier_Error": "Carrier", "NAS_Error": "NAS",
        "Weather_Error": "Weather", "Security_Error": "Security",
    }
    texts = ", ".join(f"{_thousands(n)} AS {n}" for n in names)
    line = " || ' | ' || ".join(f"'{label}: ' || {_thousands(n)}" for n, label in names.items())
    return f"{_CLEAN} SELECT {texts}, {line} AS line FROM ({_CAUSE_SUMS} FROM clean)"


def _step_status() -> str:
    """The last event of each run and step, by an explicit ranking of all events."""
    return f"""
    {_LINES},
    timed AS (
        SELECT run_id, line_no, regexp_extract(line, {_TIMING}, 1)::INTEGER AS step,
            try_cast(regexp_extract(line, {_TIMING}, 2) AS DOUBLE) AS seconds
        FROM lines WHERE regexp_matches(line, {_TIMING})
    ),
    events_of_steps AS (
        SELECT run_id, step, line_no, 0 AS place, 'finish' AS status FROM timed WHERE step BETWEEN 1 AND 5
        UNION ALL
        SELECT run_id, step + 1, line_no, 0, 'process' FROM timed WHERE step BETWEEN 1 AND 4
        UNION ALL
        SELECT run_id, n, line_no, n, 'process'
        FROM lines, (SELECT unnest(range(1, 6))::INTEGER AS n) WHERE contains(line, '[PHASE ' || n || ']')
    ),
    last_event AS (
        SELECT run_id, step, status FROM events_of_steps
        QUALIFY row_number() OVER (PARTITION BY run_id, step ORDER BY line_no DESC, place DESC) = 1
    ),
    last_time AS (
        SELECT run_id, step, seconds FROM timed
        QUALIFY row_number() OVER (PARTITION BY run_id, step ORDER BY line_no DESC) = 1
    ),
    titles(step, title) AS (
        VALUES (1, 'Engine Initialization'), (2, 'HDFS Ingestion'), (3, 'Data Cleaning'),
            (4, 'Aggregation'), (5, 'Machine Learning')
    ),
    status AS (
        SELECT r.run_id, t.step, t.title, coalesce(e.status, 'wait') AS status, s.seconds
        FROM (SELECT DISTINCT run_id FROM lines) r CROSS JOIN titles t
        LEFT JOIN last_event e ON e.run_id = r.run_id AND e.step = t.step
        LEFT JOIN last_time s ON s.run_id = r.run_id AND s.step = t.step
    )
    """


ORACLES = {
    "flights_pruned": f"""{_FLIGHTS}
        SELECT CANCELLED, ARR_DELAY, DEP_DELAY, OP_UNIQUE_CARRIER, ORIGIN, ORIGIN_CITY_NAME, DEST,
            CARRIER_DELAY, WEATHER_DELAY, NAS_DELAY, SECURITY_DELAY, LATE_AIRCRAFT_DELAY,
            DISTANCE, FL_DATE
        FROM flights""",
    "flights_clean": f"{_CLEAN} SELECT * EXCLUDE (flight_id) FROM clean",
    "stage_counts": f"""{_ML}
        SELECT 'raw' AS stage, count(*) AS n FROM flights
        UNION ALL SELECT 'clean', count(*) FROM clean
        UNION ALL SELECT 'train', count(*) FROM ml WHERE {IN_TRAIN}
        UNION ALL SELECT 'test', count(*) FROM ml WHERE NOT {IN_TRAIN}""",
    "delay_causes": f"{_CLEAN} {_CAUSE_SUMS} FROM clean",
    "raw_delay_causes": f"{_FLIGHTS} {_CAUSE_SUMS} FROM flights",
    "delay_causes_text": _causes_text(),
    "delay_cause_share": f"""{_CLEAN}
        SELECT cause, minutes, round(100 * minutes / sum(minutes) OVER (), 1) AS pct
        FROM (
            UNPIVOT (
                SELECT sum(LATE_AIRCRAFT_DELAY) AS "Late Aircraft", sum(CARRIER_DELAY) AS Carrier,
                    sum(NAS_DELAY) AS NAS, sum(WEATHER_DELAY) AS Weather,
                    sum(SECURITY_DELAY) AS Security
                FROM clean
            ) ON COLUMNS(*) INTO NAME cause VALUE minutes
        )""",
    "origin_delays": f"{_CLEAN} {_ORIGINS.format(table='clean')}",
    "top_origin_delays": f"{_CLEAN} {_top('clean', 10)}",
    "raw_top_origin_delays": f"{_FLIGHTS} {_top('flights', 10)}",
    "worst_origin": f"{_CLEAN} {_top('clean', 1)}",
    "origin_delays_text": f"""{_CLEAN}
        SELECT ORIGIN, ORIGIN_CITY_NAME,
            ORIGIN || ' (' || ORIGIN_CITY_NAME || '): ' || Avg_Dep_Delay_Minutes::VARCHAR
            || ' min avg delay (' || {_thousands('Total_Flights')} || ' flights)' AS line
        FROM ({_top('clean', 10)})""",
    "monthly_delays": f"{_CLEAN} {_MONTHS.format(table='clean')}",
    "raw_monthly_delays": f"{_FLIGHTS} {_MONTHS.format(table='flights')}",
    "monthly_trend": f"""{_CLEAN}
        SELECT Flight_Month, strftime(make_date(2000, Flight_Month, 1), '%b') AS Month_Name,
            Avg_Arr_Delay_Minutes
        FROM ({_MONTHS.format(table='clean')})""",
    "monthly_delays_text": f"""{_CLEAN}
        SELECT Flight_Month, 'Month ' || coalesce(Flight_Month::VARCHAR, 'None') || ': ' || Avg_Arr_Delay_Minutes::VARCHAR
            || ' min avg delay (' || {_thousands('Total_Flights')} || ' flights)' AS line
        FROM ({_MONTHS.format(table='clean')})""",
    "delay_rollup": f"""{_FLIGHTS}, marked AS (
            SELECT *, month(try_cast(FL_DATE AS DATE))::INTEGER AS Flight_Month,
                coalesce(CANCELLED = 0, false) AND ARR_DELAY IS NOT NULL AND DEP_DELAY IS NOT NULL
                    AND OP_UNIQUE_CARRIER IS NOT NULL AND ORIGIN IS NOT NULL AND DEST IS NOT NULL
                    AS is_clean
            FROM flights
        ), filled AS (
            SELECT * REPLACE (
                CASE WHEN is_clean THEN coalesce(LATE_AIRCRAFT_DELAY, 0) ELSE LATE_AIRCRAFT_DELAY END AS LATE_AIRCRAFT_DELAY,
                CASE WHEN is_clean THEN coalesce(CARRIER_DELAY, 0) ELSE CARRIER_DELAY END AS CARRIER_DELAY,
                CASE WHEN is_clean THEN coalesce(NAS_DELAY, 0) ELSE NAS_DELAY END AS NAS_DELAY,
                CASE WHEN is_clean THEN coalesce(WEATHER_DELAY, 0) ELSE WEATHER_DELAY END AS WEATHER_DELAY,
                CASE WHEN is_clean THEN coalesce(SECURITY_DELAY, 0) ELSE SECURITY_DELAY END AS SECURITY_DELAY
            ) FROM marked
        )
        SELECT ORIGIN, ORIGIN_CITY_NAME, Flight_Month, is_clean, count(*) AS flights,
            count(DEP_DELAY) AS dep_flights, sum(DEP_DELAY) AS dep_minutes,
            count(ARR_DELAY) AS arr_flights, sum(ARR_DELAY) AS arr_minutes,
            count(*) FILTER (ARR_DELAY > 15) AS late_flights,
            sum(LATE_AIRCRAFT_DELAY) AS Late_Aircraft_Error, sum(CARRIER_DELAY) AS Carrier_Error,
            sum(NAS_DELAY) AS NAS_Error, sum(WEATHER_DELAY) AS Weather_Error,
            sum(SECURITY_DELAY) AS Security_Error
        FROM filled GROUP BY ORIGIN, ORIGIN_CITY_NAME, Flight_Month, is_clean""",
    "delay_label_counts": f"{_LABELLED} SELECT IS_DELAYED, count(*) AS n FROM labelled GROUP BY 1",
    "sample_by_key": f"{_CLEAN} SELECT * FROM clean WHERE {SAMPLED}",
    "split_by_key": f"""{_CLEAN}
        SELECT *, CASE WHEN {IN_TRAIN} THEN 'train' ELSE 'test' END AS side FROM clean""",
    "ml_input": f"""{_ML}
        SELECT OP_UNIQUE_CARRIER, DISTANCE, FL_DATE, IS_DELAYED FROM ml""",
    "carrier_index": f"""{_CLEAN}
        SELECT OP_UNIQUE_CARRIER,
            (row_number() OVER (ORDER BY count(*) DESC, OP_UNIQUE_CARRIER) - 1)::DOUBLE AS CARRIER_INDEX
        FROM clean GROUP BY OP_UNIQUE_CARRIER""",
    "ml_features": f"""{_ML}, numbered AS (
            SELECT OP_UNIQUE_CARRIER,
                (row_number() OVER (ORDER BY count(*) DESC, OP_UNIQUE_CARRIER) - 1)::DOUBLE AS CARRIER_INDEX
            FROM ml GROUP BY OP_UNIQUE_CARRIER
        )
        SELECT IS_DELAYED, CARRIER_INDEX, DISTANCE::DOUBLE AS DISTANCE,
            month(try_cast(FL_DATE AS DATE))::DOUBLE AS Month_Index
        FROM ml JOIN numbered USING (OP_UNIQUE_CARRIER)
        WHERE month(try_cast(FL_DATE AS DATE)) IS NOT NULL""",
    "log_lines": f"{_LINES} SELECT * FROM lines",
    "log_step_timings": f"""{_LINES}
        SELECT run_id, line_no, regexp_extract(line, {_TIMING}, 1)::INTEGER AS step,
            try_cast(regexp_extract(line, {_TIMING}, 2) AS DOUBLE) AS seconds
        FROM lines WHERE regexp_matches(line, {_TIMING})""",
    "log_phases": rf"""{_LINES}
        SELECT run_id, line_no, regexp_extract(line, '\[PHASE ([1-5])\]', 1)::INTEGER AS phase
        FROM lines WHERE regexp_matches(line, '\[PHASE ([1-5])\]')""",
    "log_line_classes": f"""{_LINES}
        SELECT run_id, line_no, line,
            CASE WHEN contains(line, '[ERROR]') OR contains(line, 'Exception') THEN 'error'
                WHEN contains(line, '[SUCCESS]') OR contains(line, '[DONE]') THEN 'success'
                WHEN contains(line, '[PHASE') THEN 'phase'
                WHEN contains(line, '[Task') THEN 'task'
                WHEN contains(line, '-->') OR contains(line, '- Impact of') THEN 'result'
                WHEN contains(line, '---') THEN 'section'
                ELSE 'plain' END AS line_class
        FROM lines""",
    "log_step_status": f"{_step_status()} SELECT run_id, step, title, status, seconds FROM status",
    "log_current_step": f"""{_step_status()}
        SELECT run_id, coalesce(max(step) FILTER (status <> 'wait'), 1) AS step
        FROM status GROUP BY run_id""",
}
_CSV = """
    SELECT CANCELLED::FLOAT AS CANCELLED, ARR_DELAY::FLOAT AS ARR_DELAY, DEP_DELAY::FLOAT AS DEP_DELAY,
        OP_UNIQUE_CARRIER, ORIGIN, ORIGIN_CITY_NAME, DEST,
        CARRIER_DELAY::FLOAT AS CARRIER_DELAY, WEATHER_DELAY::FLOAT AS WEATHER_DELAY,
        NAS_DELAY::FLOAT AS NAS_DELAY, SECURITY_DELAY::FLOAT AS SECURITY_DELAY,
        LATE_AIRCRAFT_DELAY::FLOAT AS LATE_AIRCRAFT_DELAY, DISTANCE::FLOAT AS DISTANCE, FL_DATE
    FROM flights
"""
_HAS_MONTH = "month(try_cast(FL_DATE AS DATE)) IS NOT NULL"
_FINISHED, _TOTAL = r"'\[SYSTEM\] Pipeline finished \(Code: ([^)]*)\)'", r"'\[DONE\] Total\D*([\d.]+) seconds'"

ORACLES |= {
    "csv_flights": f"{_FLIGHTS} {_CSV}",
    "first_available": f"{_FLIGHTS} {_CSV}",
    "landed_flights": f"{_FLIGHTS} {_CSV} WHERE year(try_cast(FL_DATE AS DATE)) = 1995",
    "csv_inferred_delays": f"""{_FLIGHTS}, textual AS (
            SELECT * REPLACE (CASE WHEN flight_id % 97 <> 0 THEN DEP_DELAY END AS DEP_DELAY) FROM flights
        ) {_ORIGINS.format(table='textual')}""",
    "sample_counts": f"""{_ML}
        SELECT count(*) AS sampled, count(*) FILTER (NOT {_HAS_MONTH}) AS skipped,
            count(*) FILTER ({_HAS_MONTH} AND {IN_TRAIN}) AS train,
            count(*) FILTER ({_HAS_MONTH} AND NOT {IN_TRAIN}) AS test
        FROM ml""",
    # A tree that recovers the planted rule predicts the label of every row.
    "planted_predictions": f"""{_PLANTED}
        SELECT flight_id, IS_DELAYED, IS_DELAYED AS prediction FROM ml WHERE NOT {IN_TRAIN} AND {_HAS_MONTH}""",
    # The tree is right where the rule is: on every row of the test side whose rule gives its label.
    "planted_accuracy": f"""{_PLANTED}
        SELECT 'accuracy' AS metric, avg(CASE WHEN IS_DELAYED = CASE
            WHEN month(try_cast(FL_DATE AS DATE)) >= 4 AND OP_UNIQUE_CARRIER <> 'C3' THEN 1 ELSE 0 END THEN 1.0 ELSE 0.0 END)::DOUBLE AS value
        FROM ml WHERE NOT {IN_TRAIN} AND {_HAS_MONTH}""",
    # The feature whose best single cut of the training rows leaves the least Gini impurity.
    "planted_top_feature": f"""{_PLANTED}, train AS (
            SELECT IS_DELAYED AS y, month(try_cast(FL_DATE AS DATE))::DOUBLE AS m, DISTANCE::DOUBLE AS d,
                dense_rank() OVER (ORDER BY OP_UNIQUE_CARRIER)::DOUBLE AS c
            FROM ml WHERE {IN_TRAIN} AND {_HAS_MONTH}
        ), long AS (
            SELECT 'MONTH' AS feature, m AS x, y FROM train UNION ALL SELECT 'DISTANCE', d, y FROM train
            UNION ALL SELECT 'CARRIER', c, y FROM train
        ), tallied AS (SELECT feature, x, count(*) AS n, sum(y) AS late FROM long GROUP BY ALL),
        cut AS (
            SELECT feature, sum(n) OVER below AS n, sum(late) OVER below AS late,
                sum(n) OVER (PARTITION BY feature) AS n_all, sum(late) OVER (PARTITION BY feature) AS late_all
            FROM tallied WINDOW below AS (PARTITION BY feature ORDER BY x)
        )
        SELECT feature FROM cut WHERE n < n_all GROUP BY feature
        ORDER BY min(2 * late * (1 - late / n) + 2 * (late_all - late) * (1 - (late_all - late) / (n_all - n))) LIMIT 1""",
    "log_run_outcome": f"""{_LINES}, ends AS (
            SELECT run_id, regexp_extract(line, {_FINISHED}, 1) = '0' AND NOT contains(line, '[SYSTEM ERROR]') AS good
            FROM lines WHERE regexp_matches(line, {_FINISHED}) OR contains(line, '[SYSTEM ERROR]')
            QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY line_no DESC) = 1
        ), totals AS (
            SELECT run_id, try_cast(regexp_extract(line, {_TOTAL}, 1) AS DOUBLE) AS total_seconds
            FROM lines WHERE try_cast(regexp_extract(line, {_TOTAL}, 1) AS DOUBLE) IS NOT NULL
            QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY line_no DESC) = 1
        )
        SELECT r.run_id, CASE WHEN e.good IS NULL THEN 'running' WHEN e.good THEN 'completed' ELSE 'error' END AS outcome,
            t.total_seconds
        FROM (SELECT DISTINCT run_id FROM lines) r LEFT JOIN ends e USING (run_id) LEFT JOIN totals t USING (run_id)""",
}
ORACLES |= {
    "observed_stage_counts": ORACLES["stage_counts"],
    # Of several prices on a day the last quote holds.
    "flights_asof": f"""{_FLIGHTS}, prices AS ({PRICES_SQL}), days AS (
            SELECT AIRPORT, PRICE_DATE, arg_max_null(PRICE, quote_id) AS PRICE
            FROM prices WHERE AIRPORT IS NOT NULL AND PRICE_DATE IS NOT NULL GROUP BY ALL
        ), asked AS (SELECT flight_id, ORIGIN, try_cast(FL_DATE AS DATE) AS FL_DAY FROM flights)
        SELECT flight_id, ORIGIN, FL_DAY, PRICE_DATE, PRICE
        FROM asked ASOF LEFT JOIN days ON ORIGIN = AIRPORT AND FL_DAY >= PRICE_DATE""",
    "carrier_delay_quantiles": f"""{_CLEAN}
        SELECT OP_UNIQUE_CARRIER, count(*) AS n, quantile_disc(ARR_DELAY::DOUBLE, 0.5) AS p50,
            quantile_disc(ARR_DELAY::DOUBLE, 0.9) AS p90, quantile_disc(ARR_DELAY::DOUBLE, 0.99) AS p99
        FROM clean GROUP BY OP_UNIQUE_CARRIER""",
    "csv_rejects": f"""{_FLIGHTS}
        SELECT FL_DATE, OP_UNIQUE_CARRIER, ORIGIN, DEST, 'n/a' AS DEP_DELAY, 49::INTEGER AS n_values
        FROM flights WHERE flight_id % 97 = 0""",
    "csv_good_flights": f"{_FLIGHTS} {_CSV} WHERE flight_id % 97 <> 0",
    "landed_increment": f"{_FLIGHTS} {_CSV}",
    "rollup_after_updates": ORACLES["delay_rollup"],
}
def _key_hash(seed: int) -> str:
    return f"(('0x' || substr(md5(concat_ws('|', '{seed}', flight_id::VARCHAR)), 1, 15))::BIGINT)"


# Shares of 65,536 at which a Poisson number of mean 1 goes up by one.
_POISSON = [24109, 48219, 60273, 64292, 65296, 65497, 65531, 65535]
_NUMBER = "('0x' || substr(md5(concat_ws('|', (142 + b // 8)::VARCHAR, flight_id::VARCHAR)), 1 + 4 * (b % 8), 4))::INTEGER"

ORACLES |= {
    "landed_origin": f"{_FLIGHTS} {_CSV} WHERE ORIGIN = 'H3'",
    "stratified_split": f"""{_LABELLED}
        SELECT flight_id, IS_DELAYED, CASE WHEN
            row_number() OVER (PARTITION BY IS_DELAYED ORDER BY {_key_hash(42)}, flight_id)
            <= (count(*) OVER (PARTITION BY IS_DELAYED) * 700 + 500) // 1000 THEN 'train' ELSE 'test' END AS side
        FROM labelled""",
    "carrier_encoding": f"""{_LABELLED}, folded AS (
            SELECT flight_id, OP_UNIQUE_CARRIER, IS_DELAYED, {_key_hash(44)} % 5 AS fold FROM labelled
        )
        SELECT flight_id, OP_UNIQUE_CARRIER, IS_DELAYED,
            (sum(IS_DELAYED) OVER whole - sum(IS_DELAYED) OVER own + (sum(IS_DELAYED) OVER () / count(*) OVER ()) * 20.0)
            / (count(*) OVER whole - count(*) OVER own + 20.0) AS CARRIER_RATE
        FROM folded WINDOW whole AS (PARTITION BY OP_UNIQUE_CARRIER), own AS (PARTITION BY OP_UNIQUE_CARRIER, fold)""",
    "accuracy_interval": f"""{_LABELLED}, ruled AS (
            SELECT flight_id, IS_DELAYED, (IS_DELAYED = CASE WHEN DEP_DELAY > 15 THEN 1 ELSE 0 END)::INTEGER AS hit FROM labelled
        ), replicates AS (
            SELECT b, sum(w * hit) / sum(w) AS accuracy FROM (
                SELECT b, hit, {" + ".join(f"({_NUMBER} >= {s})::INTEGER" for s in _POISSON)} AS w
                FROM ruled, (SELECT unnest(range(64)) AS b)
            ) GROUP BY b
        ), ends AS (
            SELECT list_sort(list(accuracy)) AS drawn FROM replicates
        ), plain AS (SELECT count(*)::DOUBLE AS n, avg(hit) AS accuracy, avg(IS_DELAYED) AS late FROM ruled)
        SELECT 'rows' AS metric, n AS value FROM plain UNION ALL SELECT 'accuracy', accuracy FROM plain
        UNION ALL SELECT 'base_rate', greatest(late, 1 - late) FROM plain
        UNION ALL SELECT 'low', drawn[2] FROM ends UNION ALL SELECT 'high', drawn[63] FROM ends""",
}
for _name in ("causes", "top_origin_delays", "monthly_delays"):
    _direct = "delay_causes" if _name == "causes" else _name
    ORACLES[f"rollup_{_name}"] = ORACLES[_direct]
ORACLES["rollup_counts"] = f"""{_CLEAN}
    SELECT 'raw' AS stage, count(*) AS n FROM flights UNION ALL SELECT 'clean', count(*) FROM clean"""
ORACLES["rollup_label_counts"] = ORACLES["delay_label_counts"]
ORACLES["live_step_status"] = ORACLES["open_run_status"] = ORACLES["log_step_status"]
ORACLES["log_files"] = f"""{_LINES}
    SELECT run_id, row_number() OVER (PARTITION BY run_id ORDER BY line_no) AS line_no, line FROM lines"""
ORACLES["analysis_document"] = f"""{_CLEAN},
    causes AS (UNPIVOT ({_CAUSE_SUMS} FROM clean) ON COLUMNS(*) INTO NAME name VALUE value),
    numbered(name, position) AS (VALUES ('Late_Aircraft_Error', 0), ('Carrier_Error', 1), ('NAS_Error', 2),
        ('Weather_Error', 3), ('Security_Error', 4))
    SELECT 'delay_causes' AS part, position::INTEGER AS position, name, NULL::BIGINT AS flights, value
    FROM causes JOIN numbered USING (name)
    UNION ALL SELECT 'top_origin_delays', (row_number() OVER (ORDER BY Avg_Dep_Delay_Minutes DESC, ORIGIN, ORIGIN_CITY_NAME NULLS FIRST) - 1)::INTEGER,
        concat_ws('|', ORIGIN, ORIGIN_CITY_NAME), Total_Flights, Avg_Dep_Delay_Minutes FROM ({_top('clean', 10)})
    UNION ALL SELECT 'monthly_delays', (row_number() OVER (ORDER BY Avg_Arr_Delay_Minutes DESC, Flight_Month NULLS FIRST) - 1)::INTEGER,
        Flight_Month::VARCHAR, Total_Flights, Avg_Arr_Delay_Minutes FROM ({_MONTHS.format(table='clean')})"""
