"""DuckDB SQL for every registered query (independent oracle).

The SQL states each operator the direct way (interval joins, RANGE window
frames, CASE rule chains) rather than the Spark plans' pane joins and
bucketed windows, so agreement checks the Spark design, not a copy of it.
All literals are cast to double where Spark computes in doubles.
"""

from __future__ import annotations

# ---- Fixed values: stated here in SQL, apart from those the library reads, so that a slip in either shows.
MERCHANTS = """
  ('MCH_001', 'Whole Foods', 'grocery', 'US'), ('MCH_002', 'Shell Gas', 'gas', 'US'), ('MCH_003', 'Amazon', 'online', 'US'),
  ('MCH_004', 'Chase ATM', 'atm', 'US'), ('MCH_005', 'Chipotle', 'restaurant', 'US'), ('MCH_006', 'Delta Airlines', 'travel', 'US'),
  ('MCH_007', 'Walgreens', 'pharmacy', 'US'), ('MCH_008', 'Best Buy', 'retail', 'US'), ('MCH_009', 'BP Gas Station', 'gas', 'UK'),
  ('MCH_010', 'Booking.com', 'travel', 'NL'), ('MCH_011', 'LocalMart', 'grocery', 'US'), ('MCH_012', 'Uber Eats', 'restaurant', 'US'),
  ('MCH_013', 'Corner Kiosk', 'other', 'CA')"""

THR = ("(case merchant_category when 'atm' then 1500e0 when 'grocery' then 800e0 when 'gas' then 400e0 when 'online' then 2000e0 "
       "when 'restaurant' then 500e0 when 'travel' then 8000e0 when 'pharmacy' then 600e0 when 'retail' then 3000e0 else 5000e0 end)")

WIRE = ("transaction_id, user_id, amount, currency, merchant_id, merchant_name, merchant_category, merchant_country, card_type, "
        "card_last4, timestamp, device_id, ip_address, latitude, longitude, is_international, is_fraud")

REQUIRED = ["transaction_id", "user_id", "amount", "currency", "merchant_id", "merchant_name", "merchant_category",
            "merchant_country", "card_type", "card_last4", "timestamp", "is_international"]
# ---- End of fixed values.


def _d(x: float) -> str:
    return f"cast({x!r} as double)"


HOME = ("case when user_num % 5 < 4 then 'US' when user_num % 3 = 0 then 'US' "
        "when user_num % 3 = 1 then 'UK' else 'CA' end")

TXN_CTE = f"""
merchants(merchant_id, merchant_name, merchant_category, merchant_country) as (values {MERCHANTS}),
base as (
  select event_id, user_id as user_num, ts as event_time,
         'MCH_' || lpad(cast(event_id % 13 + 1 as varchar), 3, '0') as merchant_id,
         floor(value * {_d(2000.0)} + {_d(0.5)}) / {_d(100.0)} as amount
  from events),
b2 as (
  select b.*, m.merchant_name, m.merchant_category, m.merchant_country, {HOME} as home_country
  from base b left join merchants m on b.merchant_id = m.merchant_id),
txn_all as (
  select
    '00000000-0000-4000-8000-' || lpad(cast(event_id as varchar), cast(greatest(12, length(cast(event_id as varchar))) as integer), '0') as transaction_id,
    'USR_' || lpad(cast(user_num as varchar), cast(greatest(5, length(cast(user_num as varchar))) as integer), '0') as user_id,
    amount,
    case when merchant_country = 'US' then 'USD' when merchant_country = 'UK' then 'GBP' else 'EUR' end as currency,
    merchant_id, merchant_name, merchant_category, merchant_country,
    case when user_num % 3 = 2 then 'debit' else 'credit' end as card_type,
    cast((user_num * 7919) % 9000 + 1000 as varchar) as card_last4,
    strftime(event_time, '%Y-%m-%dT%H:%M:%S') || '+00:00' as "timestamp",
    case when event_id % 20 = 0 then null
         else 'device-' || cast(user_num * 2 + event_id % 2 as varchar) end as device_id,
    case when merchant_category = 'online' then '192.0.2.' || cast(event_id % 254 + 1 as varchar) end as ip_address,
    cast((event_id * 37) % 1000 as double) / {_d(1000.0)} * {_d(120.0)} - {_d(60.0)} as latitude,
    cast((event_id * 53) % 1000 as double) / {_d(1000.0)} * {_d(360.0)} - {_d(180.0)} as longitude,
    merchant_country <> home_country as is_international,
    (amount > 5000e0)
      or (home_country = 'US' and merchant_country <> 'US' and amount > 500e0)
      or (hour(event_time) between 2 and 5 and merchant_category = 'atm'
          and amount > 300e0) as is_fraud,
    event_time, event_id, home_country
  from b2),
txn as (select {WIRE}, event_time from txn_all)"""

HOUR_RE = r"^[0-9]{4}-?[0-9]{2}-?[0-9]{2}[T ]([0-9]{2})"
WRITTEN_HOUR = (f"(case when regexp_extract(\"timestamp\", '{HOUR_RE}', 1) <> '' "
                f"and cast(regexp_extract(\"timestamp\", '{HOUR_RE}', 1) as integer) <= 23 "
                f"then cast(regexp_extract(\"timestamp\", '{HOUR_RE}', 1) as integer) "
                f"when regexp_matches(\"timestamp\", '^[0-9]{{4}}-?[0-9]{{2}}-?[0-9]{{2}}$') then 0 end)")

HIGH_PRED = f"amount > {THR}"
HIGH_CONF = (f"floor(least({_d(1.0)}, (amount / {THR} - {_d(1.0)}) * {_d(0.5)} + {_d(0.6)}) "
             f"* {_d(1000.0)} + {_d(0.5)}) / {_d(1000.0)}")
HIGH_REASON = f"printf('Amount $%.2f exceeds %s threshold $%.2f', amount, coalesce(merchant_category, 'None'), {THR})"
INTL_PRED = (f"merchant_category = 'atm' and coalesce(is_international, false) "
             f"and amount > 200e0")
INTL_REASON = f"printf('International ATM withdrawal of $%.2f', amount)"
ODD_PRED = (f"{WRITTEN_HOUR} between 1 and 4 "
            f"and amount > 200e0")
ODD_REASON = f"printf('$%.2f transaction at %02d:xx', amount, {WRITTEN_HOUR})"

SCORED_CTE = f"""
scored as (
  select *,
    case when {HIGH_PRED} then true when {INTL_PRED} then true when {ODD_PRED} then true else false end as stateless_fraud,
    case when {HIGH_PRED} then 'HIGH_AMOUNT' when {INTL_PRED} then 'INTL_ATM_WITHDRAWAL'
         when {ODD_PRED} then 'UNUSUAL_HOUR' else 'CLEAN' end as fraud_rule,
    case when {HIGH_PRED} then {HIGH_CONF} when {INTL_PRED} then 0.80e0
         when {ODD_PRED} then 0.65e0 else {_d(0.0)} end as fraud_confidence,
    case when {HIGH_PRED} then {HIGH_REASON} when {INTL_PRED} then {INTL_REASON}
         when {ODD_PRED} then {ODD_REASON} else 'No fraud signals detected' end as fraud_reason
  from txn)"""

BURSTS_CTE = """
bursts as (
  select user_id, ws as window_start, ws + interval '24 hours' as window_end, count(*) as txn_count
  from (select user_id, time_bucket(interval '4 hours', event_time, timestamp '1970-01-01') - k * interval '4 hours' as ws
        from txn, range(6) r(k)) x
  group by user_id, ws having count(*) > 6),
vflag as (
  select t.transaction_id, max(b.txn_count) as txn_count
  from txn t join bursts b on t.user_id = b.user_id
   and t.event_time >= b.window_start and t.event_time < b.window_end
  group by t.transaction_id)"""

ENRICHED_CTE = f"""{SCORED_CTE},{BURSTS_CTE},
enriched as (
  select s.*, v.txn_count, v.txn_count is not null as velocity_fraud,
    s.stateless_fraud or v.txn_count is not null as final_is_fraud,
    case when v.txn_count is not null then 'VELOCITY_BURST' when s.stateless_fraud then s.fraud_rule
         else 'CLEAN' end as final_rule
  from scored s left join vflag v on s.transaction_id = v.transaction_id),
txn_table as (
  select transaction_id, user_id, cast(amount as decimal(12,2)) as amount, coalesce(currency, 'USD') as currency,
    merchant_id, merchant_name, merchant_category, merchant_country, card_type, card_last4, event_time,
    coalesce(is_international, false) as is_international, coalesce(final_is_fraud, false) as final_is_fraud,
    final_rule, cast(fraud_confidence as decimal(5,3)) as fraud_confidence,
    timestamp '2024-02-01 00:00:00' as created_at
  from enriched),
alerts as (
  select transaction_id, user_id, amount, merchant_category, merchant_country, final_rule,
    fraud_confidence, fraud_reason, event_time as alert_time
  from enriched where final_is_fraud),
alerts_table as (
  select transaction_id, user_id, cast(amount as decimal(12,2)) as amount, merchant_category, merchant_country,
    final_rule, cast(fraud_confidence as decimal(5,3)) as fraud_confidence, fraud_reason, alert_time,
    false as reviewed, cast(null as timestamp) as reviewed_at, cast(null as boolean) as true_positive,
    timestamp '2024-02-01 00:00:00' as created_at
  from alerts),
reviews as (
  select transaction_id, true as reviewed, alert_time + interval '1 hour' as reviewed_at,
    cast(substring(transaction_id, 25) as bigint) % 4 <> 0 as true_positive
  from alerts_table where cast(substring(transaction_id, 25) as bigint) % 3 = 0),
reviewed_alerts as (
  select a.transaction_id, a.user_id, a.amount, a.merchant_category, a.merchant_country, a.final_rule,
    a.fraud_confidence, a.fraud_reason, a.alert_time,
    coalesce(r.reviewed, a.reviewed) as reviewed, coalesce(r.reviewed_at, a.reviewed_at) as reviewed_at,
    coalesce(r.true_positive, a.true_positive) as true_positive, a.created_at
  from alerts_table a left join reviews r on a.transaction_id = r.transaction_id)"""


def _with(*ctes: str) -> str:
    return "with " + ",".join(ctes)


def _round(x: str, d: int) -> str:
    s = float(10 ** d)
    return f"(floor(({x}) * {_d(s)} + {_d(0.5)}) / {_d(s)})"


TXN_TABLE_DOUBLE = ("transaction_id, user_id, cast(amount as double) as amount, currency, merchant_id, merchant_name, "
                    "merchant_category, merchant_country, card_type, card_last4, event_time, is_international, "
                    "final_is_fraud, final_rule, cast(fraud_confidence as double) as fraud_confidence, created_at")
ALERTS_DOUBLE = ("transaction_id, user_id, cast(amount as double) as amount, merchant_category, merchant_country, "
                 "final_rule, cast(fraud_confidence as double) as fraud_confidence, fraud_reason, alert_time, "
                 "reviewed, reviewed_at, true_positive, created_at")

DEFECTIVE_CTE = f"""
defective as (
  select
    event_id,
    case when event_id % 40 = 6 then null
         when event_id % 40 = 8 then 'txn-' || cast(event_id as varchar) else transaction_id end as transaction_id,
    user_id,
    case when event_id % 40 = 0 then -amount when event_id % 40 = 1 then cast('nan' as double)
         when event_id % 40 = 9 then null when event_id % 40 = 10 then cast(1e12 as double) else amount end as amount,
    case when event_id % 40 = 2 then 'USDX' else currency end as currency,
    merchant_id, merchant_name,
    case when event_id % 40 = 4 then 'casino' else merchant_category end as merchant_category,
    merchant_country,
    case when event_id % 40 = 7 then 'prepaid' else card_type end as card_type,
    case when event_id % 40 = 3 then '12a4' else card_last4 end as card_last4,
    case when event_id % 40 = 5 then 'not-a-time' when event_id % 40 = 11 then '2024-02-30T10:00:00Z'
         when event_id % 40 = 12 then lower("timestamp") else "timestamp" end as "timestamp",
    is_international
  from txn_all),
validated as (
  select *, concat_ws(',', {{checks}}) as violations from defective),
validated2 as (select *, violations = '' as is_valid from validated)"""


UUID_PATTERN = "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
DATETIME_PATTERN = ("^[0-9]{4}-[0-9]{2}-[0-9]{2}[Tt ][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]+)?)?"
                    "([Zz]|[+-][0-9]{2}:?[0-9]{2})?$")


def _checks_sql() -> str:
    parts = [f"case when {f if f != 'timestamp' else chr(34) + 'timestamp' + chr(34)} is null then 'missing:{f}' end"
             for f in REQUIRED]
    cats = "'grocery', 'gas', 'online', 'atm', 'restaurant', 'travel', 'retail', 'pharmacy'"
    cards = "'credit', 'debit'"
    parts += [
        f"case when not regexp_matches(transaction_id, '{UUID_PATTERN}') then 'format:transaction_id' end",
        "case when isnan(amount) or isinf(amount) then 'number:amount' end",
        f"case when amount < {_d(0.0)} then 'minimum:amount' end",
        "case when not isnan(amount) and not isinf(amount) and amount >= cast(1e10 as double) then 'maximum:amount' end",
        "case when length(currency) <> 3 then 'length:currency' end",
        f"case when merchant_category not in ({cats}) then 'enum:merchant_category' end",
        f"case when card_type not in ({cards}) then 'enum:card_type' end",
        f"case when not regexp_matches(card_last4, '^[0-9]{{4}}$') then 'pattern:card_last4' end",
        f"case when not regexp_matches(\"timestamp\", '{DATETIME_PATTERN}') "
        "or try_cast(upper(\"timestamp\") as timestamptz) is null and \"timestamp\" is not null then 'format:timestamp' end",
    ]
    return ", ".join(parts)


def _validated_with() -> str:
    return _with(TXN_CTE, DEFECTIVE_CTE.replace("{checks}", _checks_sql()))


def oracle_sql() -> dict[str, str]:
    E = _with(TXN_CTE, ENRICHED_CTE)
    T = _with(TXN_CTE)
    S_ = _with(TXN_CTE, SCORED_CTE)
    sql = {}
    sql["txn_projection"] = f"{T} select {WIRE}, event_time from txn"
    sql["json_roundtrip"] = f"{T} select {WIRE} from txn"
    sql["publish_records"] = f"{T} select {WIRE}, user_id as key from txn"
    sql["event_time_parse"] = (f"{T} select transaction_id, \"timestamp\", date_trunc('second', event_time) as parsed_time, "
                               f"{WRITTEN_HOUR} as written_hour from txn")
    sql["validate_transactions"] = (f"{_validated_with()} select transaction_id, user_id, currency, merchant_category, "
                                    "card_type, card_last4, \"timestamp\", violations, is_valid from validated2")
    sql["quality_report"] = (f"{_validated_with()} select violation, count(*) as row_count from "
                             "(select unnest(string_split(violations, ',')) as violation from validated2 "
                             "where violations <> '') x group by violation")
    sql["enrich_merchant"] = (f"{T} select transaction_id, merchant_id, merchant_name, merchant_category, "
                              "merchant_country from txn")
    sql["enrich_international"] = (f"{T} select user_id, transaction_id, merchant_country, home_country, "
                                   "merchant_country <> home_country as is_international from txn_all")
    sql["enrich_currency"] = f"{T} select transaction_id, merchant_country, currency from txn"
    sql["rule_high_amount"] = (f"{T} select transaction_id, case when {HIGH_PRED} then 'HIGH_AMOUNT' end as rule_name, "
                               f"case when {HIGH_PRED} then {HIGH_CONF} end as confidence, "
                               f"case when {HIGH_PRED} then {HIGH_REASON} end as reason from txn")
    sql["rule_international_atm"] = (f"{T} select transaction_id, case when {INTL_PRED} then 'INTL_ATM_WITHDRAWAL' end as rule_name, "
                                     f"case when {INTL_PRED} then 0.80e0 end as confidence, "
                                     f"case when {INTL_PRED} then {INTL_REASON} end as reason from txn")
    sql["rule_odd_hours"] = (f"{T} select transaction_id, case when {ODD_PRED} then 'UNUSUAL_HOUR' end as rule_name, "
                             f"case when {ODD_PRED} then 0.65e0 end as confidence, "
                             f"case when {ODD_PRED} then {ODD_REASON} end as reason from txn")
    sql["rule_first_match"] = (f"{S_} select transaction_id, stateless_fraud, fraud_rule, fraud_confidence, "
                               "fraud_reason from scored")
    names = (f"concat_ws(',', case when {HIGH_PRED} then 'HIGH_AMOUNT' end, "
             f"case when {INTL_PRED} then 'INTL_ATM_WITHDRAWAL' end, case when {ODD_PRED} then 'UNUSUAL_HOUR' end)")
    fired = (f"(case when {HIGH_PRED} then 1 else 0 end) + (case when {INTL_PRED} then 1 else 0 end) + "
             f"(case when {ODD_PRED} then 1 else 0 end)")
    sql["rule_all_matches"] = (f"{T} select transaction_id, {names} as matched_rules, "
                               f"cast({fired} as integer) as match_count from txn")
    geo = (f"home_country = 'US' and merchant_country <> 'US' and amount > 500e0")
    off = (f"hour(event_time) between 2 and 5 and merchant_category = 'atm' "
           f"and amount > 300e0")
    ext = f"amount > 5000e0"
    sql["rule_geo_anomaly"] = f"{T} select transaction_id, coalesce({geo}, false) as fired from txn_all"
    sql["rule_off_hours_atm"] = f"{T} select transaction_id, coalesce({off}, false) as fired from txn_all"
    sql["rule_extreme_amount"] = f"{T} select transaction_id, coalesce({ext}, false) as fired from txn_all"
    rapid = ("count(*) over (partition by user_id order by event_time "
             "range between interval '59999999 microseconds' preceding and current row)")
    sql["label_set"] = (f"{T}, r as (select *, {rapid} as rapid_count from txn_all), "
                        f"r2 as (select *, rapid_count >= 8 as rapid_use from r) "
                        "select transaction_id, rapid_count, rapid_use, "
                        f"case when {ext} then 'EXTREME_AMOUNT' when rapid_use then 'RAPID_USE' "
                        f"when {geo} then 'GEO_ANOMALY' when {off} then 'OFF_HOURS_ATM' else 'NONE' end as label, "
                        f"coalesce(({ext}) or rapid_use or ({geo}) or ({off}), false) as labelled_fraud from r2")
    sql["velocity_windows"] = f"{_with(TXN_CTE, BURSTS_CTE)} select user_id, window_start, window_end, txn_count from bursts"
    sql["velocity_join_windows"] = (f"{_with(TXN_CTE, BURSTS_CTE)} select t.transaction_id, t.user_id, t.event_time, "
                                    "b.window_start as velocity_window_start, b.txn_count from txn t left join bursts b "
                                    "on t.user_id = b.user_id and t.event_time >= b.window_start "
                                    "and t.event_time < b.window_end")
    sql["velocity_flag"] = (f"{_with(TXN_CTE, BURSTS_CTE)} select t.transaction_id, t.user_id, "
                            "v.txn_count is not null as velocity_fraud, v.txn_count from txn t "
                            "left join vflag v on t.transaction_id = v.transaction_id")
    sql["velocity_trailing"] = (f"{T}, c as (select transaction_id, user_id, count(*) over (partition by user_id "
                                "order by event_time range between interval '24 hours' preceding and current row) "
                                "as trailing_count from txn) select transaction_id, user_id, trailing_count, "
                                "trailing_count > 6 as trailing_fraud from c")
    sql["rapid_use"] = (f"{T}, r as (select transaction_id, user_id, {rapid} as rapid_count from txn) "
                        f"select transaction_id, user_id, rapid_count, rapid_count >= 8 "
                        "as rapid_use from r")
    sql["enriched_transactions"] = (f"{E} select transaction_id, user_id, amount, merchant_category, event_time, "
                                    "stateless_fraud, fraud_rule, fraud_confidence, fraud_reason, txn_count, "
                                    "velocity_fraud, final_is_fraud, final_rule, is_fraud from enriched")
    sql["fraud_alerts"] = f"{E} select * from alerts"
    sql["transactions_table"] = f"{E} select {TXN_TABLE_DOUBLE} from txn_table"
    sql["alerts_table"] = f"{E} select {ALERTS_DOUBLE} from alerts_table"
    sql["insert_if_absent"] = (f"{E}, target as (select * from txn_table where event_time < timestamp '2024-01-16 00:00:00'), "
                               "batch as (select * from txn_table where event_time >= timestamp '2024-01-10 00:00:00' "
                               "union all select * from txn_table where event_time >= timestamp '2024-01-10 00:00:00'), "
                               "fresh as (select distinct * from batch) "
                               f"select {TXN_TABLE_DOUBLE} from fresh where transaction_id not in "
                               "(select transaction_id from target)")
    fraud_amt = "case when final_is_fraud then amount else cast(0 as decimal(12,2)) end"
    sql["fraud_metrics"] = (f"{E} select time_bucket(interval '1 hour', event_time) as hour, "
                            "count(*) as total_transactions, count_if(final_is_fraud) as fraud_count, "
                            f"{_round(f'{_d(100.0)} * count_if(final_is_fraud) / count(*)', 3)} as fraud_rate_pct, "
                            "cast(sum(amount) as double) as total_volume_usd, "
                            f"cast(sum({fraud_amt}) as double) as fraud_volume_usd "
                            "from txn_table group by 1")
    sql["rule_performance"] = (f"{E} select final_rule, count(*) as alert_count, "
                               f"{_round('cast(sum(fraud_confidence) as double) / cast(count(fraud_confidence) as double)', 3)} as avg_confidence, "
                               f"{_round('cast(sum(amount) as double) / cast(count(amount) as double)', 2)} as avg_amount, "
                               "min(alert_time) as first_seen, max(alert_time) as last_seen "
                               "from alerts_table group by final_rule")
    summary = (f"select count(*) as total_transactions, count_if(final_is_fraud) as fraud_count, "
               f"{_round(f'{_d(100.0)} * count_if(final_is_fraud) / count(*)', 3)} as fraud_rate_pct, "
               f"{_round('cast(sum(amount) as double)', 2)} as total_volume_usd, "
               f"{_round(f'cast(sum({fraud_amt}) as double)', 2)} as fraud_volume_usd, "
               f"{_round(f'cast(sum(epoch_us(timestamp {chr(39)}2024-02-01 00:00:00{chr(39)}) - epoch_us(event_time)) as double) / cast(count(*) as double) / {_d(1e6)}', 1)} as avg_age_seconds "
               "from txn_table")
    sql["pipeline_summary"] = f"{E} {summary}"
    metrics = ", ".join(f"cast({m} as double) as {m}" for m in
                        ["total_transactions", "fraud_count", "fraud_rate_pct", "total_volume_usd",
                         "fraud_volume_usd", "avg_age_seconds"])
    sql["summary_long"] = (f"{E}, s as ({summary}), s2 as (select {metrics} from s) "
                           "select metric, value from (unpivot s2 on total_transactions, fraud_count, fraud_rate_pct, "
                           "total_volume_usd, fraud_volume_usd, avg_age_seconds into name metric value value)")
    sql["amount_sample"] = (f"{E} select transaction_id, cast(amount as double) as amount, final_is_fraud from txn_table "
                            "where amount < 2000 order by transaction_id limit 5000")
    sql["amount_histogram"] = (
        f"{E}, r as (select final_is_fraud, cast(amount as double) as a from txn_table where amount < 2000), "
        "rg as (select final_is_fraud, min(a) as lo, max(a) as hi from r group by 1), "
        f"j as (select r.final_is_fraud, lo, hi, cast(case when hi - lo > 0 then least(floor((a - lo) * {_d(60.0)} / (hi - lo)), 59) else 0 end as integer) as bin "
        "from r join rg on r.final_is_fraud = rg.final_is_fraud) "
        f"select final_is_fraud, bin, lo + bin * ((hi - lo) / {_d(60.0)}) as bin_low, "
        f"lo + (bin + 1) * ((hi - lo) / {_d(60.0)}) as bin_high, count(*) as txn_count from j group by final_is_fraud, bin, lo, hi")
    sql["alerts_by_rule"] = f"{E} select final_rule, count(*) as alert_count from alerts_table group by final_rule"
    sql["top_risk_users"] = (f"{E} select user_id, count(*) as total_txn, count_if(final_is_fraud) as fraud_txn, "
                             f"{_round(f'{_d(100.0)} * count_if(final_is_fraud) / count(*)', 1)} as fraud_rate_pct, "
                             f"{_round(f'cast(sum({fraud_amt}) as double)', 2)} as fraud_amount_usd "
                             "from txn_table group by user_id having count_if(final_is_fraud) > 0 "
                             "order by fraud_txn desc, user_id asc limit 10")
    sql["running_totals"] = (
        f"{E}, per as (select time_bucket(interval '1 hour', event_time) as bucket_start, count(*) as n, "
        "count_if(final_is_fraud) as f, min(event_time) as first_t from txn_table group by 1), "
        "cum as (select bucket_start, sum(n) over w as sent, sum(f) over w as fraud, min(first_t) over w as t0 from per "
        "window w as (order by bucket_start rows between unbounded preceding and current row)) "
        "select bucket_start, cast(sent as bigint) as sent, cast(fraud as bigint) as fraud, "
        f"{_round(f'{_d(100.0)} * fraud / sent', 3)} as fraud_pct, "
        f"{_round(f'cast(sent as double) / (cast(epoch_us(bucket_start) + 3600000000 - epoch_us(t0) as double) / {_d(1e6)})', 3)} as events_per_s "
        "from cum")
    sql["review_queue"] = f"{E} select {ALERTS_DOUBLE} from reviewed_alerts where not reviewed"
    sql["review_apply"] = f"{E} select {ALERTS_DOUBLE} from reviewed_alerts"
    sql["rule_precision"] = (f"{E} select final_rule, count(*) as reviewed_count, count_if(true_positive) as confirmed_count, "
                             f"{_round('cast(count_if(true_positive) as double) / cast(count(*) as double)', 3)} as precision "
                             "from reviewed_alerts where reviewed group by final_rule")
    sql["confusion"] = (f"{E} select final_rule, count(*) as txn_count, count_if(coalesce(is_fraud, false)) as actual_fraud, "
                        "count_if(not coalesce(is_fraud, false)) as actual_legit, "
                        f"case when final_rule <> 'CLEAN' then {_round('cast(count_if(coalesce(is_fraud, false)) as double) / cast(count(*) as double)', 3)} end as precision "
                        "from enriched group by final_rule")
    sql["scorecard"] = (f"{E}, c as (select count_if(final_is_fraud and coalesce(is_fraud, false)) as tp, "
                        "count_if(final_is_fraud and not coalesce(is_fraud, false)) as fp, "
                        "count_if(not final_is_fraud and coalesce(is_fraud, false)) as fn, "
                        "count_if(not final_is_fraud and not coalesce(is_fraud, false)) as tn from enriched) "
                        f"select tp, fp, fn, tn, case when tp + fp > 0 then {_round('cast(tp as double) / cast(tp + fp as double)', 3)} end as precision, "
                        f"case when tp + fn > 0 then {_round('cast(tp as double) / cast(tp + fn as double)', 3)} end as recall from c")
    sql["hourly_series"] = sql["fraud_metrics"]
    only_vel = "velocity_fraud and not stateless_fraud"
    sql["enriched_explain"] = (f"{E} select transaction_id, final_rule, "
                               f"case when {only_vel} then null else fraud_confidence end as fraud_confidence, "
                               f"case when {only_vel} then printf('%d transactions in 24 hours', txn_count) "
                               "else fraud_reason end as fraud_reason from enriched")
    sql["velocity_flag_expansion"] = sql["velocity_flag"]
    sql["velocity_trailing_split"] = sql["velocity_trailing"]
    sql["insert_indexed"] = sql["transactions_table"]
    sql["review_writeback"] = sql["review_apply"]
    asof = ("(case when merchant_category = 'atm' then if(event_time >= timestamp '2024-01-16 12:00:00', 750.0, 1500.0) "
            "when merchant_category = 'online' then if(event_time >= timestamp '2024-01-16 12:00:00', 1000.0, 2000.0) "
            "when merchant_category = 'travel' then if(event_time >= timestamp '2024-01-16 12:00:00', 4000.0, 8000.0) "
            "when merchant_category = 'retail' then if(event_time >= timestamp '2024-01-16 12:00:00', 1500.0, 3000.0) "
            "when merchant_category = 'grocery' then 800.0 when merchant_category = 'gas' then 400.0 "
            "when merchant_category = 'restaurant' then 500.0 when merchant_category = 'pharmacy' then 600.0 else 5000.0 end)")
    sql["rule_high_amount_asof"] = (
        f"{T}, v as (select *, cast({asof} as double) as threshold from txn) select transaction_id, threshold, "
        "case when amount > threshold then 'HIGH_AMOUNT' end as rule_name, case when amount > threshold then "
        f"{_round(f'least({_d(1.0)}, (amount / threshold - {_d(1.0)}) * {_d(0.5)} + {_d(0.6)})', 3)} end as confidence, "
        f"case when amount > threshold then printf('Amount $%.2f exceeds %s threshold $%.2f', amount, coalesce(merchant_category, 'None'), threshold) end as reason from v")
    sql["stream_high_amount_asof"] = sql["rule_high_amount_asof"]
    sql["stream_fraud_metrics"] = sql["fraud_metrics"]
    sql["stream_state_audit"] = (
        f"{T} select user_id, ws as window_start, ws + interval '24 hours' as window_end, count(*) as txn_count "
        "from (select user_id, time_bucket(interval '4 hours', event_time, timestamp '1970-01-01') - k * interval '4 hours' as ws "
        "from txn, range(6) r(k)) x group by user_id, ws "
        "having ws + interval '24 hours' > (select max(event_time) from txn) - interval '1 hour'")
    sql["stream_latency"] = (
        "with v as (select (event_id * 7919) % 90011 as ms from events), "
        "b as (select case when ms < 32 then ms else 32 * (length(bin(ms)) - 6) + (ms >> (length(bin(ms)) - 6)) end as bin, count(*) as n "
        "from v group by 1), c as (select bin, sum(n) over (order by bin) as upto, sum(n) over () as total from b), "
        "q as (select max(total) as measured, min(case when upto >= ceil(total * 0.5) then bin end) as b1, "
        "min(case when upto >= ceil(total * 0.95) then bin end) as b2, min(case when upto >= ceil(total * 0.99) then bin end) as b3 from c) "
        "select cast(measured as bigint) as measured, " + ", ".join(
            f"cast(case when b{k} < 64 then b{k} else (b{k} - 32 * (b{k} // 32 - 1)) << (b{k} // 32 - 1)::integer end as bigint) as {name}"
            for k, name in ((1, "p50_ms"), (2, "p95_ms"), (3, "p99_ms"))) + " from q")
    sql["stream_rapid_use"] = sql["rapid_use"]
    sql["stream_velocity_trailing"] = sql["velocity_trailing"]
    sql.update(stream_oracle_sql())
    return sql


# ----------------------------------------------------------------- streaming
# A replay ends with a row that closes everything open, so the results are
# those of the whole table; only rows that arrive late are missing.
LATE_CTE = """
rng as (select min(epoch_us(event_time)) as lo, max(epoch_us(event_time)) as hi from txn),
on_time as (
  select t.* from txn t, rng
  where least(floor((epoch_us(t.event_time) - lo) * 4 / (hi - lo + 1)), 3) > 0),
late_bursts as (
  select user_id, ws as window_start, ws + interval '24 hours' as window_end, count(*) as txn_count
  from (select user_id, time_bucket(interval '4 hours', event_time, timestamp '1970-01-01') - k * interval '4 hours' as ws
        from on_time, range(6) r(k)) x
  group by user_id, ws having count(*) > 6)"""


def stream_oracle_sql() -> dict[str, str]:
    E = _with(TXN_CTE, ENRICHED_CTE)
    sql = {}
    sql["stream_decode"] = (f"{_with(TXN_CTE)} select {WIRE}, date_trunc('second', event_time) as event_time, "
                            "event_time as ingest_time from txn")
    sql["stream_stateless"] = (f"{_with(TXN_CTE, SCORED_CTE)} select transaction_id, stateless_fraud, fraud_rule, "
                               "fraud_confidence, fraud_reason from scored")
    sql["stream_velocity_windows"] = f"{E} select user_id, window_start, window_end, txn_count from bursts"
    sql["stream_velocity_alerts"] = (f"{E} select transaction_id, user_id, amount, merchant_category, merchant_country, "
                                     f"'VELOCITY_BURST' as final_rule, fraud_confidence, fraud_reason, "
                                     "event_time as alert_time from scored "
                                     "where transaction_id in (select transaction_id from vflag)")
    sql["stream_transactions_table"] = f"{E} select {TXN_TABLE_DOUBLE} from txn_table"
    sql["stream_alerts_table"] = f"{E} select {ALERTS_DOUBLE} from alerts_table"
    early = ("select transaction_id, user_id, cast(cast(amount as decimal(12,2)) as double) as amount, "
             "merchant_category, merchant_country, fraud_rule as final_rule, "
             "cast(cast(fraud_confidence as decimal(5,3)) as double) as fraud_confidence, fraud_reason, "
             "event_time as alert_time, false as reviewed, cast(null as timestamp) as reviewed_at, "
             "cast(null as boolean) as true_positive, timestamp '2024-02-01 00:00:00' as created_at "
             "from scored where stateless_fraud")
    sql["stream_current_alerts"] = (f"{E}, final_a as (select {ALERTS_DOUBLE} from alerts_table), "
                                    f"early_a as ({early}) "
                                    "select * from final_a union all select * from early_a "
                                    "where transaction_id not in (select transaction_id from final_a)")
    sql["stream_early_alerts"] = f"{E}, early_a as ({early}) select * from early_a"
    sql["stream_late_data"] = (f"{_with(TXN_CTE, LATE_CTE)} "
                               "select user_id, window_start, window_end, txn_count from late_bursts")
    sql["stream_progress"] = "select count(*) as input_rows from events"
    # late: the oldest of four equal time spans, which the replay sends last
    oldest = ("(select lo, hi from rng)", "least(floor((epoch_us(event_time) - lo) * 4 / (hi - lo + 1)), 3) = 0")
    sql["stream_late_records"] = (
        f"{_with(TXN_CTE, SCORED_CTE, LATE_CTE)} select transaction_id, user_id, cast(cast(amount as decimal(12,2)) as double) as amount, "
        "event_time, stateless_fraud as final_is_fraud, fraud_rule as final_rule, "
        f"cast(cast(fraud_confidence as decimal(5,3)) as double) as fraud_confidence from scored, {oldest[0]} where {oldest[1]}")
    blocking = ", ".join(f"'{b}'" for b in ("missing:transaction_id", "missing:user_id", "missing:amount", "missing:timestamp",
                                            "number:amount", "maximum:amount", "format:timestamp"))
    every = ",".join(f"missing:{f}" for f in REQUIRED)
    places = (
        f"{_with(TXN_CTE, DEFECTIVE_CTE.replace('{checks}', _checks_sql()), LATE_CTE)}, outcome as (select d.*, t.event_time, "
        f"case when d.event_id % 40 = 13 then '{every}' else violations end as found "
        "from validated d join txn_all t on d.event_id = t.event_id), sorted as (select outcome.*, "
        f"list_has_any(string_split(found, ','), [{blocking}]) as blocked, {oldest[1]} as old from outcome, {oldest[0]}), "
        "placed as (select *, case when blocked then 'quarantine' when old then 'late' else 'transactions' end as place from sorted)")
    sql["stream_pipeline_audit"] = f"{places} select event_id, place, case when blocked then found end as violations from placed"
    # the pipeline's own alerts: rules over the good records in time, bursts among them
    sql["stream_pipeline_counters"] = (
        f"{places}, ok as (select *, date_trunc('second', event_time) as moment from placed where place = 'transactions'), "
        "windows as (select user_id, ws, count(*) as n from (select user_id, time_bucket(interval '4 hours', moment, timestamp '1970-01-01') "
        "- k * interval '4 hours' as ws from ok, range(6) r(k)) x group by user_id, ws having count(*) > 6), "
        "hit as (select distinct event_id from ok join windows w on ok.user_id = w.user_id and moment >= ws and moment < ws + interval '24 hours'), "
        f"judged as (select *, ({HIGH_PRED}) or ({INTL_PRED}) or ({ODD_PRED}) as ruled from ok), "
        "c as (select count(*) as events, count_if(coalesce(ruled, false) or event_id in (select event_id from hit)) as alerts from judged) "
        "select (select count(*) + 1 from placed) as records, (select count(*) from placed where place = 'quarantine') as quarantined, "
        "events, alerts, (select count(*) from placed where place = 'late') as late, "
        f"{_round(f'{_d(100.0)} * alerts / events', 3)} as alert_rate_pct from c")
    return sql
