"""Reference answers in SQL for every named query, for DuckDB over the sample tables.

The statements are assembled from named common table expressions, written independently of
the Spark code: plain joins and windows, no shared aggregates.
"""

from __future__ import annotations

import re

from accolade.policy import Policy
from accolade.sources.readers import BUDGET_SCHEMA, RULE_SCHEMA, shipped_rows
from accolade.sources.staging import SOURCE_COLUMNS

AS_OF = "DATE '2000-03-15'"
POLICY = Policy()


def _literal(value) -> str:
    if value is None:
        return "NULL"
    return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else repr(value)


def _values(name: str, schema) -> str:
    rows = shipped_rows(name, schema)
    cols = ", ".join(f.name for f in schema)
    body = ", ".join("(" + ", ".join(_literal(r[f.name]) for f in schema) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {body}) t({cols})"


MEASURES = POLICY.activity_measures
MONEY = {"theo_win", "actual_win", "cash_in", "dining_spend", "hotel_revenue", "jackpot_amount"}
CUMULATIVE = POLICY.cumulative_metrics


def _branch(source: str, key: str, day: str, known: dict[str, str]) -> str:
    cols = ", ".join(f"{known.get(m, '0')} AS {m}" for m in MEASURES)
    return f"SELECT {key} AS player_id, {day} AS activity_date, {cols} FROM {source}"


CTES: dict[str, str] = {
    # --- landed tables after staging ------------------------------------------------
    "q_raw_player": """
        SELECT c_custkey AS player_id, substr(c_name, 1, 8) AS first_name, substr(c_name, 10) AS last_name,
               DATE '1935-01-01' + CAST(c_custkey * 37 % 17500 AS INTEGER) AS date_of_birth,
               n_regionkey AS home_property_id,
               CASE c_custkey % 50 WHEN 0 THEN 'SelfExcluded' WHEN 1 THEN 'Banned' WHEN 2 THEN 'Inactive'
                    ELSE 'Active' END AS player_status,
               CASE WHEN c_custkey % 11 <> 0 THEN c_acctbal > 9000 END AS vip_flag,
               TIMESTAMP '1999-01-01 00:00:00' AS created_at,
               CASE WHEN c_custkey % 13 <> 0 THEN c_custkey % 97 = 0 END AS deleted
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "q_player": """
        SELECT player_id, first_name, last_name, first_name || ' ' || last_name AS full_name, date_of_birth,
               home_property_id, player_status, coalesce(vip_flag, FALSE) AS is_vip, created_at
        FROM q_raw_player WHERE deleted IS NULL OR NOT deleted""",
    "q_member": """
        SELECT c_custkey + 100000 AS member_id, c_custkey AS player_id, 'M' || c_custkey AS member_number,
               c_custkey % 5 + 1 AS tier_id,
               DATE '1979-01-01' + CAST(c_custkey * 53 % 8000 AS INTEGER) AS enroll_date,
               c_custkey % 5 AS enroll_property_id, c_custkey * 10 % 5000 AS points_balance,
               c_custkey * 7 % 3000 AS tier_credits_ytd,
               CASE WHEN c_custkey % 30 = 0 THEN 'Inactive' ELSE 'Active' END AS member_status,
               DATE '2000-03-01' AS last_activity_date,
               c_custkey % 7 <> 0 AND c_custkey % 2 = 0 AS email_opt_in,
               c_custkey % 6 <> 0 AND c_custkey % 3 = 0 AS sms_opt_in
        FROM customer WHERE c_custkey % 20 <> 19""",
    "q_tier": """
        SELECT t.* FROM (VALUES (1, 'Silver', 0, 1.0), (2, 'Gold', 1000, 1.25), (3, 'Platinum', 5000, 1.5),
                                (4, 'Diamond', 20000, 2.0), (5, 'Noir', 75000, 3.0))
                   t(tier_id, tier_name, tier_credits_required, point_multiplier)
        JOIN region ON r_regionkey + 1 = tier_id""",
    "q_line": """
        SELECT l_orderkey, l_linenumber, max(l_suppkey) AS supp, max(l_returnflag) AS flag, max(l_partkey) AS part,
               max(l_quantity) AS qty, max(CAST(l_extendedprice AS DECIMAL(18,2))) AS price,
               max(CAST(l_discount AS DECIMAL(4,2))) AS rate
        FROM lineitem GROUP BY ALL""",
    "q_session": """
        SELECT l_orderkey * 8 + l_linenumber AS session_id, o_custkey AS player_id, supp % 5 AS property_id,
               CASE flag WHEN 'A' THEN 'Slots' WHEN 'N' THEN 'Table' ELSE 'Poker' END AS game_category,
               CAST(o_orderdate + to_hours(CAST(part % 24 - 6 AS INTEGER)) AS DATE) AS gaming_date,
               o_orderdate + to_hours(CAST(part % 24 AS INTEGER)) AS start_time,
               o_orderdate + to_hours(CAST(part % 24 AS INTEGER)) + to_minutes(CAST(qty * 8 AS INTEGER)) AS end_time,
               CAST(qty * 8 AS INTEGER) AS minutes_played, price AS cash_in,
               CAST(price - CAST(price * (rate - CAST(0.03 AS DECIMAL(4,2))) AS DECIMAL(18,2)) AS DECIMAL(18,2)) AS cash_out,
               price AS coin_in_or_action, CAST(qty AS DECIMAL(18,2)) AS average_bet,
               CAST(price * rate AS DECIMAL(18,2)) AS theoretical_win,
               CAST(price * (rate - CAST(0.03 AS DECIMAL(4,2))) AS DECIMAL(18,2)) AS actual_win,
               part % 500 AS points_awarded
        FROM q_line JOIN orders ON l_orderkey = o_orderkey""",
    "q_jackpot": """
        SELECT session_id AS jackpot_id, session_id % 1000 AS asset_id, player_id,
               CAST(gaming_date + CAST(session_id % 2 AS INTEGER) AS TIMESTAMP) + to_hours(12) AS jackpot_at,
               gaming_date + CAST(session_id % 2 AS INTEGER) AS gaming_date, cash_in AS jackpot_amount,
               'Progressive' AS jackpot_type
        FROM q_session WHERE game_category = 'Poker' AND minutes_played >= 360 AND session_id % 23 <> 0""",
    "q_check": """
        SELECT o_orderkey AS check_id, o_orderkey % 25 AS outlet_id,
               CASE WHEN o_orderkey % 4 <> 0 THEN o_custkey + 100000 END AS member_id, o_orderdate AS opened_at,
               o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS closed_at,
               o_orderkey % 6 + 1 AS guest_count, CAST(o_totalprice AS DECIMAL(18,2)) AS subtotal,
               CAST(o_totalprice AS DECIMAL(18,2)) AS total_amount,
               CASE WHEN o_orderstatus = 'O' THEN 'Open' ELSE 'Closed' END AS check_status
        FROM orders""",
    "q_reservation": """
        SELECT o_orderkey AS reservation_id, CASE WHEN o_orderkey % 19 <> 0 THEN o_custkey END AS player_id,
               o_orderkey % 5 AS property_id, CAST(o_orderdate AS DATE) AS arrival_date,
               CAST(o_orderdate AS DATE) + CAST(o_orderkey % 13 + 2 AS INTEGER) AS departure_date,
               o_orderkey % 13 + 2 AS nights, CAST(o_orderkey % 200 + 100 AS DECIMAL(18,2)) AS nightly_rate,
               o_orderkey % 17 <> 0 AND o_orderkey % 3 = 0 AS is_comp,
               CASE o_orderkey % 4 WHEN 0 THEN 'Cancelled' WHEN 1 THEN 'InHouse' ELSE 'CheckedOut' END
                   AS reservation_status
        FROM orders WHERE o_orderpriority = '5-LOW'""",
    "q_comp": """
        SELECT o_orderkey AS comp_id, o_custkey + 100000 AS member_id, o_orderkey % 5 AS property_id,
               o_orderdate AS comp_at, CAST(o_orderdate AS DATE) AS comp_date,
               CASE WHEN o_orderkey % 2 = 0 THEN 'Dining' ELSE 'FreePlay' END AS comp_category,
               CAST(o_orderkey * 7 % 490 + 10 AS DECIMAL(18,2)) AS comp_amount,
               o_orderkey % 40 AS authorized_by_employee_id
        FROM orders WHERE o_orderpriority IN ('2-HIGH', '3-MEDIUM')""",
    "q_tier_history": """
        SELECT o_orderkey AS tier_history_id, o_custkey + 100000 AS member_id, o_orderkey % 5 + 1 AS old_tier_id,
               o_orderkey // 5 % 5 + 1 AS new_tier_id, CAST(o_orderdate AS DATE) AS change_date,
               'Review' AS change_reason
        FROM orders WHERE o_orderpriority = '1-URGENT'
        UNION ALL
        SELECT -member_id, member_id, NULL, 1, enroll_date, 'Enrollment' FROM q_member""",
    "q_outlet": """
        SELECT n_nationkey AS outlet_id, n_regionkey AS property_id, n_name AS outlet_name,
               CASE n_nationkey % 3 WHEN 0 THEN 'Restaurant' WHEN 1 THEN 'Bar' ELSE 'Cafe' END AS outlet_type
        FROM nation""",
    "q_property": """
        SELECT r_regionkey AS property_id, substr(r_name, 1, 3) AS property_code, r_name AS property_name
        FROM region""",
    "q_rules": _values("sample_rules.csv", RULE_SCHEMA),
    "q_budgets": _values("tier_budgets.csv", BUDGET_SCHEMA),
    # --- entity-days and what follows from them -----------------------------------------
    "q_member_check": """
        SELECT c.*, m.player_id, CAST(closed_at - INTERVAL 6 HOUR AS DATE) AS business_day
        FROM q_check c JOIN q_member m USING (member_id) WHERE check_status = 'Closed'""",
    "q_good_stay": """
        SELECT * FROM q_reservation
        WHERE player_id IS NOT NULL AND reservation_status <> 'Cancelled'""",
    "q_activity": (
        "SELECT player_id, activity_date, "
        + ", ".join(f"sum({m}) AS {m}" for m in MEASURES)
        + ", CASE WHEN sum(gaming_sessions) + sum(dining_checks) + sum(hotel_stays) > 0 THEN 1 ELSE 0 END AS visit_flag"
        + " FROM ("
        + " UNION ALL ".join([
            _branch("q_session", "player_id", "gaming_date", {
                "gaming_sessions": "1", "gaming_minutes": "minutes_played", "theo_win": "theoretical_win",
                "actual_win": "actual_win", "cash_in": "cash_in", "points_earned": "points_awarded"}),
            _branch("q_member_check", "player_id", "business_day", {"dining_checks": "1", "dining_spend": "subtotal"}),
            _branch("q_good_stay", "player_id", "arrival_date", {
                "hotel_stays": "1", "hotel_nights": "nights",
                "hotel_revenue": "CASE WHEN is_comp THEN 0 ELSE nights * nightly_rate END"}),
            _branch("q_jackpot", "player_id", "gaming_date", {"jackpot_count": "1", "jackpot_amount": "jackpot_amount"}),
        ])
        + ") GROUP BY player_id, activity_date"
    ),
    "q_totals": (
        "SELECT *, "
        + ", ".join(
            f"sum({measure}) OVER (PARTITION BY player_id ORDER BY activity_date ROWS UNBOUNDED PRECEDING) AS cum_{metric}"
            for metric, measure in CUMULATIVE.items()
        )
        + ", lag(activity_date) OVER (PARTITION BY player_id ORDER BY activity_date) AS prior_activity_date"
        + " FROM q_activity"
    ),
    # streaks by self-reference: a month starts a run when the month before has no visit
    "q_month": """
        SELECT player_id, CAST(date_trunc('month', activity_date) AS DATE) AS visit_month,
               min(activity_date) AS first_visit_in_month
        FROM q_activity WHERE visit_flag = 1 GROUP BY 1, 2""",
    "q_run": """
        SELECT m.*, sum(CASE WHEN b.player_id IS NULL THEN 1 ELSE 0 END)
                    OVER (PARTITION BY m.player_id ORDER BY m.visit_month ROWS UNBOUNDED PRECEDING) AS run
        FROM q_month m LEFT JOIN q_month b
          ON b.player_id = m.player_id AND b.visit_month = CAST(m.visit_month - INTERVAL 1 MONTH AS DATE)""",
    "q_streak": """
        SELECT player_id, visit_month, first_visit_in_month,
               count(*) OVER (PARTITION BY player_id, run ORDER BY visit_month ROWS UNBOUNDED PRECEDING) AS streak_months
        FROM q_run""",
    "q_calendar": f"""
        SELECT player_id, event_date, metric_name, CAST(v AS DOUBLE) AS metric_value, CAST(p AS DOUBLE) AS prior_value
        FROM (
            SELECT player_id, d AS event_date, 'birthday' AS metric_name, 1 AS v, 0 AS p FROM q_birthday
            UNION ALL SELECT player_id, d, 'age_at_birthday', n, n - 1 FROM q_birthday
            UNION ALL SELECT player_id, d, 'membership_years', n, n - 1 FROM q_anniversary WHERE n >= 1)
        WHERE event_date >= {AS_OF} - 45 AND event_date <= {AS_OF} + 45""",
    "q_birthday": """
        SELECT player_id, y - year(date_of_birth) AS n,
               CAST(date_of_birth + to_years(CAST(y - year(date_of_birth) AS INTEGER)) AS DATE) AS d
        FROM q_player, (VALUES (1999), (2000), (2001)) t(y)""",
    "q_anniversary": """
        SELECT p.player_id, y - year(enroll_date) AS n,
               CAST(enroll_date + to_years(CAST(y - year(enroll_date) AS INTEGER)) AS DATE) AS d
        FROM q_player p JOIN q_member m USING (player_id), (VALUES (1999), (2000), (2001)) t(y)""",
    "q_cumulative_event": " UNION ALL ".join(
        f"SELECT player_id, activity_date AS event_date, '{metric}' AS metric_name, "
        f"CAST(cum_{metric} AS DOUBLE) AS metric_value, CAST(cum_{metric} - {measure} AS DOUBLE) AS prior_value "
        f"FROM q_totals WHERE {measure} > 0"
        for metric, measure in CUMULATIVE.items()
    ),
    "q_event": """
        SELECT * FROM q_cumulative_event
        UNION ALL SELECT player_id, first_visit_in_month, 'consecutive_visit_months', streak_months, streak_months - 1
        FROM q_streak
        UNION ALL SELECT player_id, activity_date, 'days_since_prior_visit', activity_date - prior_activity_date, 0
        FROM q_totals WHERE visit_flag = 1 AND prior_activity_date IS NOT NULL
        UNION ALL SELECT player_id, activity_date, 'daily_jackpot_total', CAST(jackpot_amount AS DOUBLE), 0
        FROM q_activity WHERE jackpot_amount > 0
        UNION ALL SELECT player_id, change_date, 'tier_level', new_tier_id, old_tier_id
        FROM q_tier_history JOIN q_member USING (member_id) WHERE old_tier_id < new_tier_id
        UNION ALL SELECT * FROM q_calendar""",
    "q_crossing": """
        SELECT player_id, event_date, metric_name, metric_value, prior_value, rule_id, milestone_family, threshold
        FROM q_event JOIN q_rules USING (metric_name)
        WHERE is_active = 1 AND prior_value < threshold AND threshold <= metric_value""",
    "q_milestone": """
        SELECT md5(coalesce(CAST(player_id AS VARCHAR), '_null_') || '-' || rule_id || '-'
                   || CAST(event_date AS VARCHAR)) AS milestone_id, x.player_id, r.*, x.metric_value AS achieved_value,
               x.event_date
        FROM (SELECT player_id, event_date, rule_id, metric_value,
                     row_number() OVER (PARTITION BY player_id, milestone_family, event_date
                                        ORDER BY threshold DESC, rule_id, metric_value DESC) AS place
              FROM q_crossing) x JOIN q_rules r USING (rule_id)
        WHERE place = 1""",
    "q_signal": f"""
        SELECT player_id, recent_loss_usd, max_minutes_in_a_day, avg_daily_loss_90d,
               max_minutes_in_a_day >= 600 OR heavy AS rg_review_flag,
               CASE WHEN max_minutes_in_a_day >= 600 THEN 'extended play time'
                    WHEN heavy THEN 'losses well above guest norm' END AS rg_reason
        FROM (SELECT r.*, avg_daily_loss_90d,
                     recent_loss_usd >= 2500 AND recent_loss_usd >= 3 * greatest(coalesce(avg_daily_loss_90d, 0), 1) AS heavy
              FROM (SELECT player_id, CAST(sum(actual_win) AS DOUBLE) AS recent_loss_usd,
                           max(gaming_minutes) AS max_minutes_in_a_day
                    FROM q_activity WHERE activity_date IN ({AS_OF}, {AS_OF} - 1) GROUP BY player_id) r
              LEFT JOIN (SELECT player_id, CAST(sum(actual_win) AS DOUBLE) / count(*) AS avg_daily_loss_90d
                         FROM q_activity
                         WHERE gaming_sessions > 0 AND activity_date <= {AS_OF} - 2 AND activity_date > {AS_OF} - 90
                         GROUP BY player_id) b USING (player_id))""",
    "q_spent": f"""
        SELECT player_id, sum(CASE WHEN comp_date > {AS_OF} - 14 THEN comp_amount ELSE 0 END) AS comps_cooldown_usd,
               sum(CASE WHEN comp_date > {AS_OF} - 30 THEN comp_amount ELSE 0 END) AS comps_window_usd,
               max(comp_date) AS last_comp_date
        FROM q_comp JOIN q_member USING (member_id) WHERE comp_date <= {AS_OF} GROUP BY player_id""",
    "q_member_cards": """
        SELECT member_id, player_id FROM q_member
        UNION ALL SELECT member_id + 1000000, player_id FROM q_member WHERE member_id % 10 = 0""",
    "q_comp_cards": """
        SELECT CASE WHEN member_id % 10 = 0 AND comp_id % 3 = 0 THEN member_id + 1000000 ELSE member_id END AS member_id,
               comp_date, comp_amount
        FROM q_comp""",
    "q_spent_cards": f"""
        SELECT player_id, sum(CASE WHEN comp_date > {AS_OF} - 14 THEN comp_amount ELSE 0 END) AS comps_cooldown_usd,
               sum(CASE WHEN comp_date > {AS_OF} - 30 THEN comp_amount ELSE 0 END) AS comps_window_usd,
               max(comp_date) AS last_comp_date
        FROM q_comp_cards JOIN q_member_cards USING (member_id) WHERE comp_date <= {AS_OF} GROUP BY player_id""",
    # --- back-tests -----------------------------------------------------------------------
    "q_move": """
        SELECT member_id, change_date, old_tier_id, new_tier_id,
               row_number() OVER (PARTITION BY member_id ORDER BY change_date, tier_history_id) AS nth
        FROM q_tier_history""",
    "q_member_then": f"""
        SELECT m.* REPLACE (coalesce(
            (SELECT CASE WHEN l.member_id IS NULL THEN f.old_tier_id ELSE l.new_tier_id END
             FROM q_move f LEFT JOIN q_move l ON l.member_id = f.member_id AND l.change_date <= {AS_OF}
             WHERE f.member_id = m.member_id AND f.nth = 1 ORDER BY l.nth DESC NULLS LAST LIMIT 1), m.tier_id) AS tier_id)
        FROM q_member m WHERE enroll_date <= {AS_OF}""",
    # --- balances -------------------------------------------------------------------------
    "q_balance": (
        "SELECT a.player_id, "
        + ", ".join(f"sum({measure}) AS cum_{metric}" for metric, measure in CUMULATIVE.items())
        + """, max(activity_date) AS open_last_day, min(activity_date) FILTER (visit_flag = 1) AS open_first_visit,
               max(activity_date) FILTER (visit_flag = 1) AS open_seen_day, any_value(s.started) AS open_run_start
        FROM q_activity a LEFT JOIN (
            SELECT player_id, arg_max(year(visit_month) * 12 + month(visit_month) - streak_months + 1, visit_month) AS started
            FROM q_streak WHERE visit_month <= DATE '2000-01-31' GROUP BY player_id) s ON s.player_id = a.player_id
        WHERE activity_date <= DATE '2000-01-31' GROUP BY a.player_id"""
    ),
    "q_continued": """
        SELECT t.*, s.streak_months FROM q_totals t
        LEFT JOIN q_streak s ON s.player_id = t.player_id AND s.first_visit_in_month = t.activity_date
        WHERE t.activity_date > DATE '2000-01-31'""",
    # --- guest 360 --------------------------------------------------------------------------
    "q_snapshot": f"""
        SELECT * FROM q_totals WHERE activity_date <= {AS_OF}
        QUALIFY row_number() OVER (PARTITION BY player_id ORDER BY activity_date DESC) = 1""",
    "q_first_visit": """
        SELECT player_id, min(activity_date) AS first_visit_date FROM q_activity WHERE visit_flag = 1 GROUP BY 1""",
    "q_year": f"""
        SELECT player_id, sum(theo_win) AS theo_win_12m, sum(visit_flag) AS visit_days_12m
        FROM q_activity WHERE activity_date <= {AS_OF} AND activity_date > {AS_OF} - 365 GROUP BY 1""",
    "q_favorite_game": f"""
        SELECT player_id, game_category AS favorite_game_category
        FROM (SELECT player_id, game_category, sum(minutes_played) AS minutes FROM q_session
              WHERE gaming_date <= {AS_OF} AND gaming_date > {AS_OF} - 365 GROUP BY 1, 2)
        QUALIFY row_number() OVER (PARTITION BY player_id ORDER BY minutes DESC NULLS LAST, game_category) = 1""",
    "q_favorite_outlet": """
        SELECT player_id, outlet_name AS favorite_outlet_name, outlet_type AS favorite_outlet_type
        FROM (SELECT player_id, outlet_name, outlet_type, sum(subtotal) AS spend
              FROM q_member_check JOIN q_outlet USING (outlet_id) GROUP BY 1, 2, 3)
        QUALIFY row_number() OVER (PARTITION BY player_id ORDER BY spend DESC NULLS LAST, outlet_name, outlet_type) = 1""",
    "q_today": f"""
        SELECT player_id FROM q_activity WHERE activity_date = {AS_OF} AND visit_flag = 1""",
    "q_property_today": f"""
        SELECT player_id, property_id FROM q_session WHERE gaming_date = {AS_OF}
        QUALIFY row_number() OVER (PARTITION BY player_id ORDER BY end_time DESC, session_id DESC) = 1""",
    "q_in_house": f"""
        SELECT player_id, property_id FROM q_good_stay WHERE arrival_date <= {AS_OF} AND departure_date > {AS_OF}
        QUALIFY row_number() OVER (PARTITION BY player_id ORDER BY arrival_date DESC, reservation_id DESC) = 1""",
    "q_age": f"""
        SELECT p.player_id,
               2000 - year(date_of_birth) - CASE WHEN strftime(date_of_birth, '%m%d') > '0315' THEN 1 ELSE 0 END AS age_years,
               2000 - year(enroll_date) - CASE WHEN strftime(enroll_date, '%m%d') > '0315' THEN 1 ELSE 0 END AS member_years
        FROM q_player p LEFT JOIN q_member USING (player_id)""",
    "q_eligibility": """
        SELECT p.player_id,
               m.member_id IS NOT NULL AND player_status = 'Active' AND member_status = 'Active' AND age_years >= 21
                   AS is_eligible,
               CASE WHEN m.member_id IS NULL THEN 'not a loyalty member'
                    WHEN player_status <> 'Active' THEN 'player status: ' || player_status
                    WHEN member_status <> 'Active' THEN 'member status: ' || member_status
                    WHEN age_years < 21 THEN 'under minimum age' END AS ineligible_reason
        FROM q_player p JOIN q_age a USING (player_id) LEFT JOIN q_member m USING (player_id)""",
    "q_guest": f"""
        SELECT p.player_id, m.member_id, m.member_number, p.first_name, p.last_name, p.full_name, a.age_years, p.is_vip,
               p.player_status, m.member_status, m.enroll_date, a.member_years, m.tier_id, t.tier_name, m.points_balance,
               m.email_opt_in, m.sms_opt_in, p.home_property_id, h.property_name AS home_property_name,
               coalesce(pt.property_id, ih.property_id, p.home_property_id) AS current_property_id,
               f.first_visit_date, s.activity_date AS last_visit_date, {AS_OF} - s.activity_date AS days_since_last_visit,
               {", ".join(f"coalesce(s.cum_{m}, 0) AS {m}" for m in CUMULATIVE)},
               coalesce(y.theo_win_12m, 0) AS theo_win_12m, coalesce(y.visit_days_12m, 0) AS visit_days_12m,
               g.favorite_game_category, o.favorite_outlet_name, o.favorite_outlet_type,
               p.player_id IN (SELECT player_id FROM q_today) AS on_property_today,
               ih.player_id IS NOT NULL AS in_house_tonight, {AS_OF} AS as_of_date,
               c.property_name AS current_property_name, e.ineligible_reason, coalesce(e.is_eligible, FALSE) AS is_eligible
        FROM q_player p JOIN q_age a USING (player_id) JOIN q_eligibility e USING (player_id)
        LEFT JOIN q_member m ON m.player_id = p.player_id
        LEFT JOIN q_tier t ON t.tier_id = m.tier_id
        LEFT JOIN q_property h ON h.property_id = p.home_property_id
        LEFT JOIN q_snapshot s ON s.player_id = p.player_id
        LEFT JOIN q_first_visit f ON f.player_id = p.player_id
        LEFT JOIN q_year y ON y.player_id = p.player_id
        LEFT JOIN q_favorite_game g ON g.player_id = p.player_id
        LEFT JOIN q_favorite_outlet o ON o.player_id = p.player_id
        LEFT JOIN q_property_today pt ON pt.player_id = p.player_id
        LEFT JOIN q_in_house ih ON ih.player_id = p.player_id
        LEFT JOIN q_property c ON c.property_id = coalesce(pt.property_id, ih.property_id, p.home_property_id)""",
    # --- recommendations and worklist ---------------------------------------------------------
    "q_open": f"""
        SELECT *, {AS_OF} - event_date AS days_since_event FROM q_milestone
        WHERE event_date + recognition_window_days >= {AS_OF} AND event_date - lead_days <= {AS_OF}""",
    "q_scored": """
        SELECT o.*, g.* EXCLUDE (player_id), coalesce(s.rg_review_flag, FALSE) AS rg_review_flag, s.rg_reason,
               coalesce(CAST(b.comps_cooldown_usd AS DOUBLE), 0.0) AS comps_cooldown_usd,
               coalesce(CAST(b.comps_window_usd AS DOUBLE), 0.0) AS comps_window_usd,
               CAST(coalesce(q.max_reward_usd_30d, 100.0) AS DOUBLE) - coalesce(CAST(b.comps_window_usd AS DOUBLE), 0.0)
                   AS remaining_budget_usd,
               CAST(priority_weight AS DOUBLE) + 3 * coalesce(g.tier_id, 1)
                   + CASE WHEN on_property_today OR in_house_tonight THEN 15 ELSE 0 END
                   + CASE WHEN is_vip THEN 5 ELSE 0 END
                   - 0.5 * 3 * CASE WHEN days_since_event < 0 THEN 0 WHEN days_since_event > 14 THEN 14
                                    ELSE days_since_event END AS score
        FROM q_open o JOIN q_guest g ON g.player_id = o.player_id
        LEFT JOIN q_signal s ON s.player_id = o.player_id
        LEFT JOIN q_spent b ON b.player_id = o.player_id
        LEFT JOIN q_budgets q ON q.tier_id = g.tier_id""",
    "q_decided": """
        SELECT *, CASE WHEN NOT is_eligible THEN 'INELIGIBLE' WHEN rg_review_flag THEN 'RG_CHECK_IN'
                       WHEN comps_cooldown_usd >= 25 AND score < 90 THEN 'SUPPRESSED_COOLDOWN'
                       WHEN reward_budget_usd > 0 AND remaining_budget_usd <= 0 THEN 'SUPPRESSED_BUDGET'
                       ELSE 'RECOMMEND' END AS status
        FROM q_scored""",
    "q_rec": f"""
        SELECT milestone_id AS recommendation_id, {AS_OF} AS as_of_date, player_id, first_name, last_name, full_name,
               tier_id, tier_name, is_vip, current_property_id, current_property_name, on_property_today,
               in_house_tonight, rule_id, milestone_family, milestone_name, achieved_value, event_date, days_since_event,
               event_date + recognition_window_days AS actionable_through, status AS recommendation_status,
               rg_review_flag, rg_reason, round(score, 1) AS priority_score,
               CASE status WHEN 'RG_CHECK_IN' THEN {_literal(POLICY.check_in_action)} ELSE recommended_action END
                   AS final_action,
               CASE status WHEN 'RG_CHECK_IN' THEN 'PersonalNote' ELSE reward_type END AS final_reward_type,
               CAST(CASE WHEN status <> 'RECOMMEND' THEN 0
                         WHEN remaining_budget_usd <= 0 THEN 0
                         WHEN remaining_budget_usd < reward_budget_usd THEN remaining_budget_usd
                         ELSE reward_budget_usd END AS DOUBLE) AS approved_reward_usd,
               action_owner,
               CASE status WHEN 'RG_CHECK_IN' THEN replace({_literal(POLICY.check_in_text)}, '{{first_name}}', first_name)
                    ELSE replace(replace(talking_point, '{{first_name}}', first_name), '{{value}}',
                                 CAST(CAST(round(achieved_value) AS BIGINT) AS VARCHAR)) END AS talking_point,
               favorite_outlet_name, favorite_game_category, visit_days_12m, lifetime_visit_days, lifetime_theo_win,
               member_years, comps_cooldown_usd, comps_window_usd, remaining_budget_usd
        FROM q_decided""",
    "q_best": """
        SELECT * FROM (
            SELECT *, row_number() OVER (PARTITION BY player_id ORDER BY recommendation_status <> 'RG_CHECK_IN',
                                         priority_score DESC, recommendation_id) AS place
            FROM q_rec WHERE recommendation_status IN ('RECOMMEND', 'RG_CHECK_IN'))""",
    "q_headline": """
        SELECT b.*, o.other_milestones FROM q_best b
        LEFT JOIN (SELECT player_id, string_agg(milestone_name, ', ' ORDER BY place) AS other_milestones
                   FROM q_best WHERE place > 1 GROUP BY player_id) o USING (player_id)
        WHERE place = 1""",
    "q_listed": """
        SELECT *, row_number() OVER (PARTITION BY current_property_id ORDER BY recommendation_status <> 'RG_CHECK_IN',
                                     priority_score DESC, recommendation_id) AS worklist_rank
        FROM q_headline QUALIFY worklist_rank <= 25""",
    "q_worklist": """
        SELECT as_of_date, current_property_id AS property_id, current_property_name AS property_name, worklist_rank,
               recommendation_id, player_id, full_name AS guest_name, tier_name,
               CASE WHEN in_house_tonight THEN 'In house tonight' WHEN on_property_today THEN 'On property today'
                    ELSE 'Not on property yet' END AS presence,
               recommendation_status, rg_reason, milestone_name AS headline_milestone,
               final_action AS recommended_action, action_owner, final_reward_type AS reward_type, approved_reward_usd,
               talking_point, other_milestones, actionable_through, priority_score,
               'Member ' || CAST(member_years AS VARCHAR) || ' yrs - ' || CAST(CAST(lifetime_visit_days AS BIGINT) AS VARCHAR)
                   || ' visits - favorite spot: ' || coalesce(favorite_outlet_name, 'n/a') AS guest_context
        FROM q_listed""",
    "q_unguarded": """
        SELECT recommendation_id, player_id, rg_review_flag, recommendation_status, remaining_budget_usd,
               CASE WHEN rg_review_flag THEN 'GamingOffer' ELSE final_reward_type END AS final_reward_type,
               approved_reward_usd + CASE WHEN rg_review_flag THEN 1000.0 ELSE 0.0 END AS approved_reward_usd,
               CASE WHEN recommendation_status = 'RG_CHECK_IN' THEN milestone_name ELSE talking_point END AS talking_point
        FROM q_rec""",
    "q_case": """
        SELECT *, CASE WHEN NOT eligible THEN 'INELIGIBLE' WHEN flagged THEN 'RG_CHECK_IN'
                       WHEN recent_comps >= 25 AND score < 90 THEN 'SUPPRESSED_COOLDOWN'
                       WHEN rule_budget > 0 AND remaining <= 0 THEN 'SUPPRESSED_BUDGET' ELSE 'RECOMMEND' END AS status
        FROM (SELECT check_id, check_id % 11 <> 0 AS eligible, check_id % 7 = 0 AS flagged, check_id % 60 AS recent_comps,
                     CAST(check_id % 1000 AS DOUBLE) / 2 - 100 AS rule_budget,
                     CAST(check_id % 700 AS DOUBLE) - 200 AS remaining,
                     CAST(check_id % 66 + 30 AS DOUBLE) + 3 * (check_id % 5 + 1)
                     + CASE WHEN check_id % 3 = 0 THEN 15 ELSE 0 END
                     + CASE WHEN check_id % 13 <> 0 AND check_id % 4 = 0 THEN 5 ELSE 0 END
                     - CAST(3 * least(greatest(check_id % 30 - 5, 0), 14) AS DOUBLE) / 2 AS score
              FROM q_check)""",
    "q_kept": f"""
        SELECT player_id, c.player_id % 40 AS visits, a.member_years,
               CASE WHEN player_id % 3 <> 0 THEN last_name END AS spot
        FROM q_player c JOIN q_age a USING (player_id)""",
}

# One letter per output type.
TYPES = {"b": "BIGINT", "d": "DOUBLE", "t": "DATE", "s": "VARCHAR", "f": "BOOLEAN", "m": "TIMESTAMP"}


def _columns(spec: str) -> str:
    """``name:type`` words to a cast list; a bare name is passed through."""
    cols = []
    for word in spec.split():
        name, _, kind = word.partition(":")
        cols.append(f"CAST({name} AS {TYPES[kind]}) AS {name}" if kind else name)
    return ", ".join(cols)


def _with(final: str) -> str:
    """Prefix the expressions a statement uses, in dependency order."""
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"\bq_\w+", text):
            if name not in ordered and name in CTES:
                visit(CTES[name])
                if name not in ordered:
                    ordered.append(name)

    visit(final)
    if not ordered:
        return final
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n].strip()})" for n in ordered) + "\n" + final


def _pick(spec: str, source: str) -> str:
    return _with(f"SELECT {_columns(spec)} FROM {source}")


EVENT = "player_id:b event_date:t metric_name:s metric_value:d prior_value:d"
#: The 360 of a back-test: the same statements over the members of the day.
CTES |= {
    f"{name}_then": re.sub(r"\b(q_member|q_age|q_eligibility)\b", r"\1_then", CTES[name]) for name in ("q_age", "q_eligibility", "q_guest")
}

MEASURE_COLUMNS = " ".join(f"{m}:{'d' if m in MONEY else 'b'}" for m in MEASURES)
LIFETIME_COLUMNS = "lifetime_theo_win:d lifetime_visit_days:b lifetime_hotel_nights:b lifetime_dining_spend:d"
STAGED_COLUMNS = {
    "player": "player_id:b first_name:s last_name:s full_name:s date_of_birth:t home_property_id:b player_status:s "
              "is_vip:f created_at:m",
    "player_session": "session_id:b player_id:b property_id:b game_category:s gaming_date:t start_time:m end_time:m "
                      "minutes_played:b cash_in:d cash_out:d coin_in_or_action:d average_bet:d theoretical_win:d "
                      "actual_win:d points_awarded:b",
    "jackpot": "jackpot_id:b asset_id:b player_id:b jackpot_at:m gaming_date:t jackpot_amount:d jackpot_type:s",
    "member": "member_id:b player_id:b member_number:s tier_id:b enroll_date:t enroll_property_id:b points_balance:b "
              "tier_credits_ytd:b member_status:s last_activity_date:t email_opt_in:f sms_opt_in:f",
    "tier": "tier_id:b tier_name:s tier_credits_required:b point_multiplier:d",
    "tier_history": "tier_history_id:b member_id:b old_tier_id:b new_tier_id:b change_date:t change_reason:s",
    "comp": "comp_id:b member_id:b property_id:b comp_at:m comp_date:t comp_category:s comp_amount:d "
            "authorized_by_employee_id:b",
    "check": "check_id:b outlet_id:b member_id:b opened_at:m closed_at:m guest_count:b subtotal:d total_amount:d "
             "check_status:s",
    "outlet": "outlet_id:b property_id:b outlet_name:s outlet_type:s",
    "reservation": "reservation_id:b player_id:b property_id:b arrival_date:t departure_date:t nights:b nightly_rate:d "
                   "is_comp:f reservation_status:s",
    "property": "property_id:b property_code:s property_name:s",
}
assert set(STAGED_COLUMNS) == set(SOURCE_COLUMNS)

GUEST = (
    "player_id:b member_id:b member_number:s first_name:s last_name:s full_name:s age_years:b is_vip:f player_status:s "
    "member_status:s enroll_date:t member_years:b tier_id:b tier_name:s points_balance:b email_opt_in:f sms_opt_in:f "
    "home_property_id:b home_property_name:s current_property_id:b first_visit_date:t last_visit_date:t "
    f"days_since_last_visit:b {LIFETIME_COLUMNS} theo_win_12m:d visit_days_12m:b favorite_game_category:s "
    "favorite_outlet_name:s favorite_outlet_type:s on_property_today:f in_house_tonight:f as_of_date:t "
    "current_property_name:s ineligible_reason:s is_eligible:f"
)
REC = (
    "recommendation_id:s as_of_date:t player_id:b first_name:s last_name:s full_name:s tier_id:b tier_name:s is_vip:f "
    "current_property_id:b current_property_name:s on_property_today:f in_house_tonight:f rule_id:s milestone_family:s "
    "milestone_name:s achieved_value:d event_date:t days_since_event:b actionable_through:t recommendation_status:s "
    "rg_review_flag:f rg_reason:s priority_score:d final_action:s final_reward_type:s approved_reward_usd:d "
    "action_owner:s talking_point:s favorite_outlet_name:s favorite_game_category:s visit_days_12m:b "
    "lifetime_visit_days:b lifetime_theo_win:d member_years:b comps_cooldown_usd:d comps_window_usd:d "
    "remaining_budget_usd:d"
)
MILESTONE = (
    "milestone_id:s player_id:b rule_id:s milestone_family:s milestone_name:s metric_name:s threshold:d "
    "achieved_value:d event_date:t lead_days:b recognition_window_days:b reward_type:s reward_budget_usd:d "
    "action_owner:s priority_weight:b recommended_action:s talking_point:s"
)
WORKLIST = (
    "as_of_date:t property_id:b property_name:s worklist_rank:b recommendation_id:s player_id:b guest_name:s "
    "tier_name:s presence:s recommendation_status:s rg_reason:s headline_milestone:s recommended_action:s "
    "action_owner:s reward_type:s approved_reward_usd:d talking_point:s other_milestones:s actionable_through:t "
    "priority_score:d guest_context:s"
)
ZERO_FILL = ", ".join(
    f"CAST({ {'dining_checks': '1', 'dining_spend': 'subtotal'}.get(m, '0') } AS "
    f"{'DOUBLE' if m == 'dining_spend' else 'BIGINT'}) AS {m}"
    for m in MEASURES
)
FRESH = " UNION ALL ".join(
    f"SELECT '{t}' AS source, newest, age_hours, CASE WHEN age_hours > 24 THEN 'error' WHEN age_hours > 2 THEN 'warn' "
    f"ELSE 'pass' END AS status FROM (SELECT max({c}) AS newest, "
    f"CAST(epoch_us(TIMESTAMP '2024-01-31 00:00:00') - epoch_us(max({c})) AS DOUBLE) / 3.6e9 AS age_hours FROM {t})"
    for t, c in (("events", "ts"), ("orders", "o_orderdate"), ("lineitem", "l_shipdate"))
)


def _violations(name: str, table: str, count: str) -> str:
    return f"SELECT '{name}' AS \"check\", '{table}' AS \"table\", CAST(({count}) AS BIGINT) AS violations"


def _null_row(table: str, source: str, column: str) -> str:
    return _violations(f"not_null({column})", table, f"SELECT count(*) FROM {source} WHERE {column} IS NULL")


def _unique_row(table: str, source: str, *columns: str) -> str:
    keys = ", ".join(columns)
    where = f"WHERE {columns[0]} IS NOT NULL" if len(columns) == 1 else ""
    return _violations(
        f"unique({keys})", table,
        f"SELECT count(*) FROM (SELECT {keys} FROM {source} {where} GROUP BY {keys} HAVING count(*) > 1)",
    )


def _where_row(name: str, table: str, source: str, bad: str) -> str:
    return _violations(name, table, f"SELECT count(*) FROM {source} WHERE {bad}")


def _report() -> str:
    keyed = {
        "player": ("player_id",), "member": ("member_id", "player_id"), "player_session": ("session_id",),
        "check": ("check_id",), "reservation": ("reservation_id",),
    }
    cte = {"player_session": "q_session"}
    rows = []
    for table, columns in keyed.items():
        for c in columns:
            source = cte.get(table, f"q_{table}")
            rows += [_null_row(table, source, c), _unique_row(table, source, c)]
    rewards = "'PersonalNote', 'NonGaming', 'GamingOffer', 'Experience'"
    metrics = ("'lifetime_theo_win', 'lifetime_visit_days', 'lifetime_hotel_nights', 'lifetime_dining_spend', "
               "'consecutive_visit_months', 'days_since_prior_visit', 'daily_jackpot_total', 'tier_level', "
               "'membership_years', 'birthday', 'age_at_birthday'")
    statuses = "'RECOMMEND', 'RG_CHECK_IN', 'SUPPRESSED_COOLDOWN', 'SUPPRESSED_BUDGET', 'INELIGIBLE'"
    rows += [
        _null_row("rules", "q_rules", "rule_id"),
        _null_row("rules", "q_rules", "reward_budget_usd"),
        _unique_row("rules", "q_rules", "rule_id"),
        _where_row("accepted_values(reward_type)", "rules", "q_rules", f"reward_type NOT IN ({rewards})"),
        _where_row("accepted_values(metric_name)", "rules", "q_rules", f"metric_name NOT IN ({metrics})"),
        _null_row("guardrails", "q_budgets", "tier_id"),
        _unique_row("guardrails", "q_budgets", "tier_id"),
        _null_row("guest_activity_daily", "q_activity", "player_id"),
        _unique_row("guest_activity_daily", "q_activity", "player_id", "activity_date"),
        _null_row("guest_metric_events", "q_event", "metric_name"),
        _null_row("guest_rg_signals", "q_signal", "player_id"),
        _unique_row("guest_rg_signals", "q_signal", "player_id"),
        _null_row("guest_360", "q_guest", "player_id"),
        _null_row("guest_360", "q_guest", "is_eligible"),
        _unique_row("guest_360", "q_guest", "player_id"),
        _null_row("guest_milestones", "q_milestone", "milestone_id"),
        _unique_row("guest_milestones", "q_milestone", "milestone_id"),
        _where_row("relationships(rule_id)", "guest_milestones", "q_milestone",
                   "rule_id NOT IN (SELECT rule_id FROM q_rules)"),
        _null_row("recommendations", "q_rec", "recommendation_id"),
        _unique_row("recommendations", "q_rec", "recommendation_id"),
        _where_row("accepted_values(recommendation_status)", "recommendations", "q_rec",
                   f"recommendation_status NOT IN ({statuses})"),
        _where_row("no_incentive_when_flagged", "recommendations", "q_rec",
                   "rg_review_flag AND (final_reward_type = 'GamingOffer' OR approved_reward_usd > 0)"),
        _where_row("reward_within_budget", "recommendations", "q_rec",
                   "approved_reward_usd > greatest(remaining_budget_usd, 0)"),
        _where_row("script_match", "recommendations", "q_rec",
                   "recommendation_status = 'RG_CHECK_IN' AND talking_point NOT LIKE '%play limits and time-outs%'"),
        _null_row("daily_worklist", "q_worklist", "recommendation_id"),
        _null_row("daily_worklist", "q_worklist", "player_id"),
        _unique_row("daily_worklist", "q_worklist", "recommendation_id"),
        _unique_row("daily_worklist", "q_worklist", "player_id"),
        _unique_row("daily_worklist", "q_worklist", "property_id", "player_id"),
        _where_row("excludes_ineligible", "daily_worklist",
                   "q_worklist JOIN q_guest USING (player_id)", "NOT is_eligible"),
    ]
    return _with(" UNION ALL ".join(rows))


def oracle_sql() -> dict[str, str]:
    """Query name to SQL."""
    out = {
        "scan_sources": " UNION ALL ".join(
            f"SELECT '{t}' AS source, count(*) AS n_rows FROM {t}"
            for t in ("region", "nation", "customer", "orders", "lineitem")
        ),
        "select_normalized": _pick("session_id:b player_id:b gaming_date:t minutes_played:b", "q_session"),
        "live_rows": _with(
            "SELECT player_id AS playerid, deleted AS _deleted FROM q_raw_player WHERE deleted IS NULL OR NOT deleted"
        ),
        "minimize_columns": _pick(
            "player_id:b first_name:s last_name:s date_of_birth:t home_property_id:b player_status:s vip_flag:f "
            "created_at:m", "q_raw_player"),
        "rules_catalog": _with(
            "SELECT rule_id, milestone_family, metric_name, CAST(threshold AS DOUBLE) AS threshold, "
            "CAST(lead_days AS BIGINT) AS lead_days, CAST(recognition_window_days AS BIGINT) AS recognition_window_days, "
            "reward_type, CAST(reward_budget_usd AS DOUBLE) AS reward_budget_usd, CAST(is_active AS BIGINT) AS is_active, "
            "(SELECT count(*) FROM q_crossing c WHERE c.rule_id = r.rule_id) AS n_events FROM q_rules r"),
        "budget_catalog": _with(
            "SELECT CAST(tier_id AS BIGINT) AS tier_id, tier_name, CAST(max_reward_usd_30d AS DOUBLE) AS max_reward_usd_30d, "
            "(SELECT count(*) FROM q_member m WHERE m.tier_id = b.tier_id) AS n_members FROM q_budgets b"),
        "table_sink_roundtrip": _with(
            "SELECT check_status, count(*) AS n, CAST(sum(subtotal) AS DOUBLE) AS subtotal FROM q_check GROUP BY 1"),
        "source_freshness": FRESH,
        "staging_views": _with(
            "SELECT player_status, count(*) AS n_guests, count(member_id) AS n_members "
            "FROM q_player LEFT JOIN q_member USING (player_id) GROUP BY player_status"),
        "clock_day": _pick(
            "player_id:b activity_date:t visit_flag:b", f"q_activity WHERE activity_date = {AS_OF}"),
        "stage_projection": _pick(
            "jackpot_id:b player_id:b full_name:s is_vip:f gaming_date:t jackpot_amount:d",
            "q_jackpot JOIN q_player USING (player_id)"),
        "filter_status_in": _pick("reservation_id:b player_id:b reservation_status:s", "q_good_stay"),
        "zero_fill": _with(f"SELECT check_id, {ZERO_FILL} FROM q_check"),
        "business_day": _with(
            f"SELECT check_id, d AS business_day, d = {AS_OF} AS is_today FROM "
            "(SELECT check_id, CAST(closed_at - INTERVAL 6 HOUR AS DATE) AS d FROM q_check)"),
        "date_arith": _with(
            f"SELECT reservation_id, CAST({AS_OF} - arrival_date AS BIGINT) AS days, 2000 - year(arrival_date) AS years, "
            "CAST(arrival_date + INTERVAL 4 YEAR AS DATE) AS four_years_on, arrival_date + 45 AS days_on, "
            "CAST(date_trunc('month', arrival_date) AS DATE) AS month_start, "
            "year(arrival_date) * 12 + month(arrival_date) AS month_index, day(arrival_date) AS day_of_month "
            "FROM q_reservation"),
        "age_on": _pick("player_id:b age_years:b member_years:b", "q_age"),
        "priority_score": _with("SELECT check_id, round(score, 1) AS priority_score FROM q_case"),
        "status_cascade": _with("SELECT check_id, status AS recommendation_status FROM q_case"),
        "capped_reward": _with(
            "SELECT check_id, CAST(CASE WHEN status = 'RECOMMEND' THEN greatest(least(rule_budget, remaining), 0) "
            "ELSE 0 END AS DOUBLE) AS approved_reward_usd FROM q_case"),
        "render_template": _with(
            "SELECT player_id, full_name || ', it''s ' || CAST(CAST(round(CAST(spend AS DOUBLE)) AS BIGINT) AS VARCHAR) "
            "|| ' in all' AS talking_point FROM q_player JOIN q_member USING (player_id) JOIN "
            "(SELECT member_id, sum(subtotal) AS spend FROM q_check WHERE member_id IS NOT NULL GROUP BY 1) USING (member_id)"),
        "context_text": _with(
            "SELECT player_id, 'Member ' || member_years || ' yrs - ' || visits || ' visits - ' "
            "|| coalesce('favorite spot: ' || spot, 'favorite spot: n/a') AS guest_context FROM q_kept"),
        "surrogate_key": _with(
            "SELECT check_id, md5(check_id || '-' || coalesce(CAST(member_id AS VARCHAR), '_null_') || '-' || "
            "CAST(CAST(closed_at AS DATE) AS VARCHAR)) AS key FROM q_check"),
        "actionable_window": _pick("milestone_id:s player_id:b rule_id:s event_date:t days_since_event:b", "q_open"),
        "inner_equi_join": _with(
            "SELECT check_id, member_id, CAST(subtotal AS DOUBLE) AS subtotal, player_id, tier_id "
            "FROM q_check JOIN q_member USING (member_id)"),
        "left_outer_join": _with(
            "SELECT check_id, member_id, player_id FROM q_check LEFT JOIN q_member USING (member_id)"),
        "role_playing_dim": _with(
            "SELECT player_id, h.property_name AS home_name, e.property_name AS enroll_name "
            "FROM q_player p JOIN q_member m USING (player_id) LEFT JOIN q_property h ON h.property_id = home_property_id "
            "LEFT JOIN q_property e ON e.property_id = enroll_property_id"),
        "threshold_crossing": _pick(EVENT + " rule_id:s milestone_family:s threshold:d", "q_crossing"),
        "trailing_window": _pick("player_id:b theo_win_12m:d visit_days_12m:b", "q_year"),
        "latest_snapshot": _pick(
            "player_id:b activity_date:t cum_lifetime_theo_win:d cum_lifetime_visit_days:b cum_lifetime_hotel_nights:b "
            "cum_lifetime_dining_spend:d", "q_snapshot"),
        "presence_flags": _pick("player_id:b on_property_today:f in_house_tonight:f current_property_id:b", "q_guest"),
        "eligibility": _with(
            "SELECT player_id, coalesce(is_eligible, FALSE) AS is_eligible, ineligible_reason FROM q_eligibility"),
        "headline_per_entity": _pick(
            "player_id:b recommendation_id:s recommendation_status:s priority_score:d milestone_name:s", "q_headline"),
        "fold_others": _pick("player_id:b milestone_name:s other_milestones:s", "q_headline"),
        "topn_per_partition": _with(
            "SELECT outlet_id, check_id, CAST(subtotal AS DOUBLE) AS subtotal, "
            "row_number() OVER (PARTITION BY outlet_id ORDER BY q_check.subtotal DESC, check_id) AS rank "
            "FROM q_check WHERE check_status = 'Closed' QUALIFY rank <= 25"),
        "dq_unique": _with(
            "SELECT player_id, count(*) AS n FROM q_reservation WHERE player_id IS NOT NULL GROUP BY 1 HAVING n > 1"),
        "dq_not_null": _pick("check_id:b check_status:s", "q_check WHERE member_id IS NULL"),
        "dq_accepted_values": _with(
            "SELECT player_status, count(*) AS n FROM q_player WHERE player_status NOT IN ('Active', 'Inactive') GROUP BY 1"),
        "dq_relationships": _with(
            "SELECT member_id, count(*) AS n FROM q_comp WHERE member_id NOT IN (SELECT member_id FROM q_member) GROUP BY 1"),
        "dq_one_row_per_key": _with(
            "SELECT outlet_id, member_id, count(*) AS n FROM q_check GROUP BY 1, 2 HAVING count(*) > 1"),
        "dq_unique_combination": (
            "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, count(*) AS n FROM lineitem "
            "GROUP BY ALL HAVING count(*) > 1"),
        "dq_no_incentive_when_flagged": _pick(
            "recommendation_id:s player_id:b final_reward_type:s approved_reward_usd:d",
            "q_unguarded WHERE rg_review_flag AND (final_reward_type = 'GamingOffer' OR approved_reward_usd > 0)"),
        "dq_reward_within_budget": _pick(
            "recommendation_id:s player_id:b approved_reward_usd:d remaining_budget_usd:d",
            "q_unguarded WHERE approved_reward_usd > greatest(remaining_budget_usd, 0)"),
        "dq_script_match": _pick(
            "recommendation_id:s player_id:b talking_point:s",
            "q_unguarded WHERE recommendation_status = 'RG_CHECK_IN' "
            "AND NOT contains(talking_point, 'play limits and time-outs')"),
        "dq_excludes_ineligible": _pick(
            "player_id:b ineligible_reason:s", "q_rec JOIN q_guest USING (player_id) WHERE NOT is_eligible"),
        "dq_report": _report(),
        "entity_day_activity": _pick(f"player_id:b activity_date:t {MEASURE_COLUMNS} visit_flag:b", "q_activity"),
        "visit_flag": _pick("player_id:b activity_date:t visit_flag:b", "q_activity"),
        "running_totals": _pick(
            f"player_id:b activity_date:t {MEASURE_COLUMNS} visit_flag:b cum_lifetime_theo_win:d "
            "cum_lifetime_visit_days:b cum_lifetime_hotel_nights:b cum_lifetime_dining_spend:d prior_activity_date:t",
            "q_totals"),
        "visit_streaks": _pick("player_id:b visit_month:t first_visit_in_month:t streak_months:b", "q_streak"),
        "calendar_events": _pick(EVENT, "q_calendar"),
        "unpivot_cumulative": _pick(EVENT, "q_cumulative_event"),
        "metric_events": _pick(EVENT, "q_event"),
        "baseline_anomaly": _pick(
            "player_id:b recent_loss_usd:d max_minutes_in_a_day:b avg_daily_loss_90d:d rg_review_flag:f rg_reason:s",
            "q_signal"),
        "comp_budget": _pick("player_id:b comps_cooldown_usd:d comps_window_usd:d last_comp_date:t", "q_spent_cards"),
        "favorite_game": _pick("player_id:b favorite_game_category:s", "q_favorite_game"),
        "favorite_outlet": _pick("player_id:b favorite_outlet_name:s favorite_outlet_type:s", "q_favorite_outlet"),
        "property_today": _pick("player_id:b property_id:b", "q_property_today"),
        "in_house": _pick("player_id:b property_id:b", "q_in_house"),
        "milestones": _pick(MILESTONE, "q_milestone"),
        "entity_360": _pick(GUEST, "q_guest"),
        "recommendations": _pick(REC, "q_rec"),
        "recommendations_from_balances": _pick(REC, "q_rec"),
        "refreshed_milestones": _pick(MILESTONE, "q_milestone"),
        "strict_360": _pick(GUEST, "q_guest_then"),
        "tier_on_day": _pick("member_id:b tier_id:b", "q_member_then"),
        "check_tier": _pick(
            "check_id:b member_id:b day:t tier_then:b",
            """(SELECT c.check_id, c.member_id, c.day, CASE WHEN l.member_id IS NULL THEN f.old_tier_id ELSE l.new_tier_id END AS tier_then
                FROM (SELECT check_id, member_id, CAST(closed_at - INTERVAL 6 HOUR AS DATE) AS day FROM q_check) c
                LEFT JOIN q_move f ON f.member_id = c.member_id AND f.nth = 1
                LEFT JOIN q_move l ON l.member_id = c.member_id AND l.change_date <= c.day
                QUALIFY row_number() OVER (PARTITION BY c.check_id ORDER BY l.nth DESC NULLS LAST) = 1)"""),
        "opening_balances": _pick(
            "player_id:b cum_lifetime_theo_win:d cum_lifetime_visit_days:b cum_lifetime_hotel_nights:b cum_lifetime_dining_spend:d "
            "open_last_day:t open_first_visit:t open_seen_day:t open_run_start:b", "q_balance"),
        "continued_totals": _pick(
            "player_id:b activity_date:t cum_lifetime_theo_win:d cum_lifetime_visit_days:b cum_lifetime_hotel_nights:b "
            "cum_lifetime_dining_spend:d prior_activity_date:t streak_months:b", "q_continued"),
        "worklist": _pick(WORKLIST, "q_worklist"),
        "worklist_for_property": _pick(
            "worklist_rank:b guest_name:s tier_name:s presence:s headline_milestone:s recommended_action:s action_owner:s "
            "approved_reward_usd:d talking_point:s other_milestones:s",
            "q_worklist WHERE property_name = 'EUROPE'"),
    }
    sources = {"player_session": "q_session"}
    for name, spec in STAGED_COLUMNS.items():
        out[f"stg_{name}"] = _pick(spec, sources.get(name, f"q_{name}"))
    return out
