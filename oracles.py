"""SQL that gives the result of each registered query on the same tables, for DuckDB."""

K = "CAST(regexp_extract(props, '\"k\": *([0-9]+)', 1) AS BIGINT)"


def _slide(source: str, size_panes: int, every: str, keys: str, aggs: str) -> str:
    """Aggregate ``source`` (with ts) per sliding window by copying each row into its windows."""
    group = "".join(f", {k}" for k in keys.split(", ") if k)
    return f"""
    SELECT w AS window_start, w + {size_panes} * INTERVAL {every} AS window_end{group}, {aggs}
    FROM (SELECT *, time_bucket(INTERVAL {every}, ts) - i * INTERVAL {every} AS w
          FROM ({source}) s, range({size_panes}) r(i)) x
    GROUP BY w{group}"""


def _top(counts: str, item: str, n: int) -> str:
    return f"""
    SELECT * FROM (
      SELECT *, CAST(row_number() OVER (PARTITION BY window_start ORDER BY count DESC, {item}) AS INTEGER) AS rank
      FROM ({counts}) c) t
    WHERE rank <= {n}"""


_COUNT = "CAST(count(*) AS BIGINT) AS count"
_HASH = """list_reduce(list_prepend(CAST(0 AS BIGINT),
    list_transform(string_split({text}, ''), lambda c: CAST(unicode(c) AS BIGINT))),
    lambda h, u: (h * {seed} + u) & {mask})"""
_PLACES = """(SELECT n_nationkey, n_name AS city, r_name AS area
    FROM nation JOIN region ON n_regionkey = r_regionkey)"""
_USER_PLACES = f"""(SELECT c_custkey AS user_id, city, area
    FROM customer JOIN {_PLACES} p ON c_nationkey = n_nationkey)"""
_SALES = f"""(SELECT l_orderkey, l_linenumber, p_name AS product, city, area
    FROM lineitem LEFT JOIN part ON l_partkey = p_partkey
    LEFT JOIN (SELECT s_suppkey, city, area FROM supplier LEFT JOIN {_PLACES} p ON s_nationkey = n_nationkey) s
      ON l_suppkey = s_suppkey)"""
_KINDS = """CAST(count(*) FILTER (l_returnflag = 'R') AS BIGINT) AS clicks,
    CAST(count(*) FILTER (l_returnflag = 'N') AS BIGINT) AS orders,
    CAST(count(*) FILTER (l_returnflag = 'A') AS BIGINT) AS pays"""
_CATEGORIES = f"""SELECT p_brand AS category, {_KINDS}
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand"""
_HOUR = "time_bucket(INTERVAL 1 HOUR, ts) AS window_start, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end"
_CAPPED = """(SELECT *, row_number() OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE)
    ORDER BY ts, event_id) AS nth FROM events)"""
_PAYS = "(SELECT user_id, event_id AS pay_event, ts AS pay_ts FROM events WHERE event_type = 'purchase')"
_RECEIPTS = "(SELECT user_id, event_id AS receipt_event, ts AS receipt_ts FROM events WHERE event_type = 'click')"
_NEAR = "p.user_id = r.user_id AND receipt_ts BETWEEN pay_ts - INTERVAL 1 HOUR AND pay_ts + INTERVAL 1 HOUR"
_REMARK = f"""
    WITH per_city AS (SELECT area, product, coalesce(city, 'null') AS city, count(*) AS n FROM {_SALES} s GROUP BY ALL),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY area, product ORDER BY n DESC, city) AS rn,
                 sum(n) OVER (PARTITION BY area, product) AS total,
                 count(*) OVER (PARTITION BY area, product) AS cities FROM per_city),
    remarked AS (SELECT area, product, CAST(any_value(total) AS BIGINT) AS count,
        string_agg(city || ' ' || CAST(n * 100 // total AS BIGINT) || ' %', ',' ORDER BY rn) FILTER (rn <= 2)
        || CASE WHEN any_value(cities) > 2
             THEN ',其它 ' || CAST(100 - sum(n * 100 // total) FILTER (rn <= 2) AS BIGINT) || ' %'
             ELSE '' END AS city_remark
      FROM ranked GROUP BY area, product)"""

ORACLES = {
    # traffic
    "hot_items": _top(
        _slide(f"SELECT ts, {K} AS item_id FROM events WHERE event_type = 'view'", 12, "30 MINUTE", "item_id", _COUNT),
        "item_id", 3,
    ),
    "hot_urls": _top(
        _slide(f"SELECT ts, '/' || {K} AS url FROM events", 12, "5 MINUTE", "url", _COUNT),
        "url", 3,
    ),
    "pv_hourly": f"SELECT {_HOUR}, CAST(count(*) AS BIGINT) AS pv FROM events WHERE event_type = 'view' GROUP BY ALL",
    "uv_exact": f"""SELECT {_HOUR}, CAST(count(DISTINCT user_id) AS BIGINT) AS uv
        FROM events WHERE event_type = 'view' GROUP BY ALL""",
    "uv_approx": """SELECT DISTINCT time_bucket(INTERVAL 1 DAY, ts) AS window_start,
        time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY AS window_end, true AS within_bound FROM events WHERE event_type = 'view'""",
    "uv_sliding": f"""SELECT window_start, window_end, true AS within_bound FROM (
        {_slide("SELECT ts FROM events WHERE event_type = 'view'", 24, "1 HOUR", "", _COUNT)}) t""",
    "uv_bitmap": f"""SELECT {_HOUR}, CAST(count(DISTINCT {_HASH.format(
        text="CAST(user_id AS VARCHAR)", seed=61, mask=(1 << 29) - 1)}) FILTER (user_id IS NOT NULL) AS BIGINT) AS uv
        FROM events WHERE event_type = 'view' GROUP BY ALL""",
    "marketing_total": f"""SELECT *, 'app' AS behavior, 'total' AS channel FROM (
        {_slide("SELECT ts FROM events WHERE event_type <> 'error'", 12, "5 MINUTE", "", _COUNT)}) t""",
    "marketing_by_channel": _slide(
        f"SELECT ts, event_type AS behavior, {K} % 4 AS channel FROM events WHERE event_type <> 'error'",
        12, "5 MINUTE", "behavior, channel", _COUNT,
    ),
    "tumble_min": f"SELECT {_HOUR}, event_type, min(value) AS min_value FROM events GROUP BY ALL",
    "processing_tumble": f"SELECT event_type, {_COUNT}, true AS is_an_hour FROM events GROUP BY event_type",
    "slide_count": _slide(
        "SELECT ts, event_type, value FROM events", 2, "30 MINUTE", "event_type",
        f"{_COUNT}, max(value) AS max_value, min(value) AS min_value",
    ),
    "sql_tumble": f"SELECT {_HOUR}, event_type, {_COUNT} FROM events GROUP BY ALL",
    "sql_hop": _slide("SELECT ts, event_type FROM events", 2, "30 MINUTE", "event_type", _COUNT),
    "recent_clicks": _slide(
        "SELECT ts, strftime(ts, '%M:%S') AS time_text FROM events WHERE event_type = 'click'", 12, "5 MINUTE", "time_text", _COUNT
    ),
    "over_rows": """SELECT event_id, user_id, ts, CAST(count(*) OVER w AS BIGINT) AS count,
        round(avg(value) OVER w, 4) AS avg_value FROM events
        WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
    "page_conversion": """
        WITH flow(from_page, to_page) AS (VALUES ('signup', 'view'), ('view', 'click'), ('click', 'purchase')),
        pairs AS (SELECT event_type AS page, lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nxt
                  FROM events),
        counted AS (SELECT from_page, to_page, CAST(count(*) FILTER (nxt = to_page) AS BIGINT) AS jumps,
                    CAST(count(*) AS BIGINT) AS visits
                    FROM pairs JOIN flow ON page = from_page GROUP BY ALL)
        SELECT *, jumps / visits AS rate FROM counted WHERE jumps > 0""",
    # alerts
    "rolling_reduce": """SELECT event_id, user_id,
        first_value(ts) OVER w + (row_number() OVER w - 1) * INTERVAL 1 SECOND AS ts,
        value + CASE WHEN row_number() OVER w > 1 THEN 10 ELSE 0 END AS value
        FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
    "jump_alert": """SELECT * FROM (SELECT event_id, user_id, ts, value,
        lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS previous FROM events) t
        WHERE abs(value - previous) > 50""",
    "rise_alert": """
        WITH RECURSIVE a AS (SELECT *, value > lag(value) OVER w AS rise, value < lag(value) OVER w AS fall FROM events
                             WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
        b AS (SELECT *, count(*) FILTER (fall) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run FROM a),
        r AS (SELECT user_id, run, ts FROM b WHERE rise),
        w(user_id, run, start_ts) AS (
            SELECT user_id, run, min(ts) FROM r GROUP BY ALL
            UNION
            SELECT r.user_id, r.run, min(r.ts) FROM w JOIN r ON r.user_id IS NOT DISTINCT FROM w.user_id AND r.run = w.run
              AND r.ts > w.start_ts + INTERVAL 12 HOUR GROUP BY ALL)
        SELECT user_id, start_ts, start_ts + INTERVAL 12 HOUR AS alert_ts FROM w
        WHERE NOT EXISTS (SELECT 1 FROM b f WHERE f.fall AND f.user_id IS NOT DISTINCT FROM w.user_id
          AND f.run > w.run AND f.ts BETWEEN w.start_ts AND w.start_ts + INTERVAL 12 HOUR)""",
    "marker_watermark": f"""
        WITH a AS (SELECT event_id, {K} AS k, ts, event_type FROM events),
        b AS (SELECT *, max(CASE WHEN event_type = 'error' THEN ts END) OVER (ORDER BY k, event_id)
              - INTERVAL 1 MINUTE AS watermark FROM a)
        SELECT *, coalesce(ts <= watermark, false) AS late FROM b""",
    "login_fail_burst": """
        WITH RECURSIVE f AS (SELECT user_id, ts, event_id, run FROM (
            SELECT *, count(*) FILTER (event_type <> 'error') OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run
            FROM events) t WHERE event_type = 'error'),
        w(user_id, run, start_ts) AS (
            SELECT user_id, run, min(ts) FROM f GROUP BY ALL
            UNION
            SELECT f.user_id, f.run, min(f.ts) FROM w JOIN f ON f.user_id IS NOT DISTINCT FROM w.user_id AND f.run = w.run
              AND f.ts > w.start_ts + INTERVAL 6 HOUR GROUP BY ALL)
        SELECT w.user_id, w.start_ts, CAST(count(*) AS BIGINT) AS n_fails
        FROM w JOIN f ON f.user_id IS NOT DISTINCT FROM w.user_id AND f.run = w.run
          AND f.ts BETWEEN w.start_ts AND w.start_ts + INTERVAL 6 HOUR
        WHERE NOT EXISTS (SELECT 1 FROM events s WHERE s.user_id IS NOT DISTINCT FROM w.user_id AND s.event_type <> 'error'
          AND s.ts BETWEEN w.start_ts AND w.start_ts + INTERVAL 6 HOUR)
        GROUP BY ALL HAVING count(*) >= 2""",
    "login_fail_cep": """
        SELECT user_id, start_ts, ts AS end_ts, event_type FROM (
          SELECT user_id, ts, event_type, lag(ts) OVER w AS start_ts, lag(event_type) OVER w AS before
          FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) t
        WHERE event_type = 'error' AND before = 'error' AND ts < start_ts + INTERVAL 6 HOUR""",
    "order_pay": """
        WITH pairs AS (SELECT o.user_id, o.event_id AS order_event, o.ts AS order_ts,
            (SELECT min_by(p.event_id, p.ts) FROM events p
             WHERE p.user_id IS NOT DISTINCT FROM o.user_id AND p.event_type = 'purchase'
               AND (p.ts > o.ts OR (p.ts = o.ts AND p.event_id > o.event_id))
               AND p.ts < o.ts + INTERVAL 12 HOUR) AS pay_event
          FROM events o WHERE o.event_type = 'signup')
        SELECT user_id, order_event, pay_event,
          CASE WHEN pay_event IS NULL THEN 'order time out' ELSE 'order pay successfully' END AS result FROM pairs""",
    "interval_join": f"""SELECT p.user_id, pay_event, pay_ts, receipt_event, receipt_ts
        FROM {_PAYS} p JOIN {_RECEIPTS} r ON {_NEAR}""",
    "reconcile": f"""
        WITH RECURSIVE both_sides AS (
            SELECT user_id, pay_ts AS ts, 0 AS side, pay_event AS event FROM {_PAYS} p
            UNION ALL SELECT user_id, receipt_ts, 1, receipt_event FROM {_RECEIPTS} r),
        e AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, side, event) AS i FROM both_sides),
        s(user_id, i, waiting, side, used) AS (
            SELECT DISTINCT user_id, 0::BIGINT, []::STRUCT(ts TIMESTAMP, event BIGINT)[], 0, NULL::STRUCT(a BIGINT, b BIGINT) FROM e
            UNION ALL
            SELECT user_id, i, CASE WHEN met THEN still[2:] ELSE list_append(still, {{'ts': ts, 'event': event}}) END,
                   CASE WHEN met THEN open_side ELSE side END, CASE WHEN met THEN {{'a': still[1].event, 'b': event}} END
            FROM (SELECT e.*, s.side AS open_side, list_filter(waiting, lambda x: x.ts >= e.ts - INTERVAL 1 HOUR) AS still,
                         len(list_filter(waiting, lambda x: x.ts >= e.ts - INTERVAL 1 HOUR)) > 0 AND s.side <> e.side AS met
                  FROM s JOIN e ON e.user_id IS NOT DISTINCT FROM s.user_id AND e.i = s.i + 1) t),
        pairs AS (SELECT CASE WHEN x.side = 0 THEN used.a ELSE used.b END AS pay_event,
                         CASE WHEN x.side = 0 THEN used.b ELSE used.a END AS receipt_event
                  FROM s JOIN both_sides x ON x.event = used.a WHERE used IS NOT NULL)
        SELECT p.user_id, p.pay_event, pay_ts, r.receipt_event, receipt_ts, 'matched' AS status
        FROM pairs JOIN {_PAYS} p USING (pay_event) JOIN {_RECEIPTS} r ON r.receipt_event = pairs.receipt_event
        UNION ALL SELECT user_id, pay_event, pay_ts, NULL, NULL, 'left_only' FROM {_PAYS} p
                  WHERE pay_event NOT IN (SELECT pay_event FROM pairs)
        UNION ALL SELECT user_id, NULL, NULL, receipt_event, receipt_ts, 'right_only' FROM {_RECEIPTS} r
                  WHERE receipt_event NOT IN (SELECT receipt_event FROM pairs)""",
    "ad_click_cap": f"SELECT user_id, event_type, CAST(ts AS DATE) AS day, event_id FROM {_CAPPED} c WHERE nth = 3",
    "ad_by_province": _slide(
        f"""SELECT ts, city AS province FROM {_CAPPED} c LEFT JOIN {_USER_PLACES} u ON c.user_id = u.user_id
            WHERE nth <= 2""",
        12, "5 MINUTE", "province", _COUNT,
    ),
    "ad_blacklist": f"""SELECT user_id, max(n) AS max_count, CAST(count(*) AS BIGINT) AS times FROM (
        SELECT CAST(ts AS DATE) AS day, user_id, {K} % 4 AS ad, CAST(count(*) AS BIGINT) AS n
        FROM events WHERE event_type = 'click' GROUP BY ALL) t WHERE n >= 2 GROUP BY user_id""",
    "blacklist_filter": """SELECT event_id, ts, user_id FROM events WHERE event_type = 'click' AND NOT EXISTS (
        SELECT 1 FROM (SELECT user_id FROM events WHERE event_type = 'click' GROUP BY user_id HAVING count(*) >= 20) b
        WHERE b.user_id = events.user_id)""",
    "ad_area_city": f"""SELECT CAST(ts AS DATE) AS day, area, city, {K} AS ad, {_COUNT}
        FROM events e LEFT JOIN {_USER_PLACES} u ON e.user_id = u.user_id
        WHERE event_type = 'click' GROUP BY ALL""",
    # products
    "ad_top3_by_province": """SELECT * FROM (
        SELECT *, CAST(row_number() OVER (PARTITION BY province ORDER BY times DESC, ad) AS INTEGER) AS rank FROM (
          SELECT n_name AS province, o_orderpriority AS ad, CAST(count(*) AS BIGINT) AS times
          FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
          GROUP BY ALL) c) t WHERE rank <= 3""",
    "category_actions": _CATEGORIES,
    "category_explode": _CATEGORIES,
    "cogroup_counts": _CATEGORIES,
    "union_counts": _CATEGORIES,
    "category_top10": f"SELECT * FROM ({_CATEGORIES}) c ORDER BY clicks DESC, orders DESC, pays DESC, category LIMIT 10",
    "star_left_join": f"SELECT * FROM {_SALES} s",
    "area_product_top3": f"""SELECT * FROM (
        SELECT *, CAST(rank() OVER (PARTITION BY area ORDER BY click_count DESC) AS INTEGER) AS rank FROM (
          SELECT area, product, CAST(count(*) AS BIGINT) AS click_count FROM {_SALES} s GROUP BY ALL) c) t
        WHERE rank <= 3""",
    "city_remark": f"{_REMARK} SELECT * FROM remarked",
    "area_product_remark": f"""{_REMARK}
        SELECT * FROM (SELECT *, CAST(rank() OVER (PARTITION BY area ORDER BY count DESC) AS INTEGER) AS rank FROM remarked) t
        WHERE rank <= 3""",
    "rank_top3": f"""SELECT * FROM (
        SELECT *, CAST(rank() OVER (PARTITION BY p_brand ORDER BY count DESC) AS INTEGER) AS rank FROM (
          SELECT p_brand, p_type, {_COUNT} FROM part GROUP BY ALL) c) t WHERE rank <= 3""",
    # basics
    "word_count": f"""SELECT word, {_COUNT} FROM (
        SELECT unnest(string_split(text, ' ')) AS word FROM documents) t WHERE word <> '' GROUP BY word""",
    "lateral_split": """SELECT p_partkey, word, CAST(length(word) AS INTEGER) AS length FROM (
        SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part) t""",
    "split_column": """SELECT o_orderkey, word, CAST(length(word) AS INTEGER) AS length FROM (
        SELECT o_orderkey, unnest(string_split(o_orderpriority, '-')) AS word FROM orders) t""",
    "scalar_hash": f"""SELECT c_custkey, c_name,
        (((h + 2147483648) & 4294967295) - 2147483648) * CAST(1.23 AS DOUBLE) AS hash
        FROM (SELECT *, {_HASH.format(text="c_name", seed=31, mask=(1 << 32) - 1)} AS h FROM customer) t""",
    "split_routes": "SELECT event_id, value, CASE WHEN value > 30 THEN 'High' ELSE 'Low' END AS route FROM events",
    "side_output": """SELECT event_id, CASE WHEN value >= 32 THEN value END AS value,
        CASE WHEN value < 32 THEN 'freezing alert ' || event_id END AS alert FROM events""",
    "co_map": """SELECT event_id, CASE WHEN value > 30 THEN value END AS value,
        CASE WHEN value > 30 THEN 'warning' ELSE 'healthy' END AS state FROM events""",
    "starts_with": "SELECT event_id, event_type, value FROM events WHERE event_type LIKE 'p%'",
    "distinct_values": "SELECT DISTINCT user_id, event_type FROM events",
    "adjacent_pairs": """SELECT * FROM (SELECT user_id, ts, event_id, event_type AS first,
        lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS second FROM events) t
        WHERE second IS NOT NULL""",
    "broadcast_lookup": """SELECT c_custkey, c_nationkey, coalesce(n_name, 'none') AS n_name FROM customer
        LEFT JOIN nation ON c_nationkey = n_nationkey + 3""",
    "keyed_max": f"SELECT user_id, max({K}) AS max_k, min({K}) AS min_k FROM events GROUP BY user_id",
    "keyed_int_avg": f"SELECT user_id, CAST(sum({K}) // count({K}) AS BIGINT) AS avg_k FROM events GROUP BY user_id",
    "two_stage_agg": f"""SELECT user_id, CAST(sum(top) AS BIGINT) AS sum_of_max FROM (
        SELECT user_id, CAST(ts AS DATE) AS day, max({K}) AS top FROM events GROUP BY ALL) t GROUP BY user_id""",
    "global_agg": """SELECT CAST(count(*) AS BIGINT) AS n,
        CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS total,
        min(o_totalprice) AS low, max(o_totalprice) AS high FROM orders""",
    "count_by_value": f"SELECT o_orderpriority, {_COUNT} FROM orders GROUP BY o_orderpriority",
    "group_count": f"SELECT o_custkey, {_COUNT} FROM orders GROUP BY o_custkey",
    "take_ordered": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10",
    "udaf_avg": """SELECT user_id,
        CAST(sum(CAST(value AS DECIMAL(18, 2))) AS DOUBLE) / count(value) AS avg_value FROM events GROUP BY user_id""",
    "top2_flat_agg": """SELECT * FROM (SELECT user_id, value,
        CAST(row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS INTEGER) AS rank FROM events) t
        WHERE rank <= 2""",
    "retract_changelog": """
        WITH prev AS (SELECT user_id, CAST(count(*) AS BIGINT) AS count FROM events
                      WHERE ts < TIMESTAMP '2024-01-16' GROUP BY user_id),
        cur AS (SELECT user_id, CAST(count(*) AS BIGINT) AS count FROM events GROUP BY user_id)
        SELECT false AS added, * FROM (SELECT * FROM prev EXCEPT SELECT * FROM cur) a
        UNION ALL SELECT true AS added, * FROM (SELECT * FROM cur EXCEPT SELECT * FROM prev) b""",
    "retract_totals": """
        SELECT user_id % 10 AS part, CAST(count(*) AS BIGINT) AS users, CAST(sum(count) AS BIGINT) AS sum_count,
               avg(count) AS avg_count, min(count) AS min_count, max(count) AS max_count
        FROM (SELECT user_id, CAST(count(*) AS BIGINT) AS count FROM events GROUP BY user_id) c GROUP BY ALL""",
    "retract_top2": """
        SELECT part, count, CAST(rank AS INTEGER) AS rank FROM (
            SELECT user_id % 10 AS part, CAST(count(*) AS BIGINT) AS count,
                   row_number() OVER (PARTITION BY user_id % 10 ORDER BY count(*) DESC) AS rank
            FROM events GROUP BY user_id) c WHERE rank <= 2""",
    "route_partitions": """SELECT event_id, event_type,
        CASE event_type WHEN 'view' THEN 0 WHEN 'click' THEN 1 ELSE 2 END AS partition FROM events""",
    "delimited_lines": """SELECT event_id, user_id, CASE WHEN event_type <> 'error' THEN event_type END AS event_type,
        ts FROM events""",
    "csv_messages": "SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer",
    "access_log": f"""SELECT '10.0.0.' || {K} AS ip, coalesce(CAST(user_id AS VARCHAR), '-') AS user_id,
        date_trunc('second', ts) AS event_time, 'GET' AS method, '/' || {K} AS url FROM events""",
    "table_views": "SELECT c_nationkey AS nation, CAST(count(*) AS BIGINT) AS customers FROM customer GROUP BY c_nationkey",
    "documents_json": """SELECT CAST(c_custkey AS VARCHAR) AS id, '{"c_name":"' || c_name || '","c_nationkey":"'
        || c_nationkey || '","c_mktsegment":"' || c_mktsegment || '"}' AS source FROM customer""",
}
