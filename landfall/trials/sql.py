"""The trial queries in SQL, for an engine that knows nothing of this package."""

from __future__ import annotations

from landfall.trials.queries import AFTER, COUNTRY, MONTH


def key(*parts: str) -> str:
    """The 60-bit key of some string or integer columns."""
    texts = " || '|' || ".join(
        f"coalesce(length(cast({p} as varchar)) || ':' || cast({p} as varchar), '~')" for p in parts
    )
    return f"cast('0x' || substr(md5({texts}), 1, 15) as bigint)"


def degrees(amount: str, times: int, half: int) -> str:
    """A number that grows with an amount and runs through the degrees, in tenths."""
    turned = f"({amount} * {times}::double - {2 * half} * floor({amount} * {times}::double / {2 * half}) - {half})"
    return f"floor({turned} * 10) / 10"


MONTH_OF = "lower(strftime(o_orderdate, '%b%y'))"
DIGITS = "strftime(o_orderdate, '%m%d%Y')"
DAYS = "date_diff('day', date '1960-01-01', cast(o_orderdate as date))"
CITY_NAME = "case when c_acctbal < 0 then c_name else c_mktsegment end"

# The stand-in feeds and the tables built from them.
PARTS = {
    "residents": """
        select * from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey""",
    "airports": """
        select s_name as ident,
               case when s_acctbal < 0 then 'closed' else 'open' end as type,
               s_name || ' Field' as name,
               cast(trunc(s_acctbal) as integer) as elevation_ft,
               case when s_acctbal > 9000 then 'CA' else 'US' end as iso_country,
               n_name as state_code,
               case when s_acctbal >= 8000 then s_name when s_acctbal >= 0 then c_mktsegment end as city,
               cast(s_suppkey as varchar) as iata_code,
               s_acctbal as pair_first, cast(s_nationkey as double) as pair_second
        from supplier join nation on s_nationkey = n_nationkey left join customer on c_custkey = s_suppkey""",
    "people": f"""
        select {CITY_NAME} as city, n_name as state_code, c_custkey, c_acctbal, c_name
        from customer join nation on c_nationkey = n_nationkey""",
    "city": f"""
        select city, state_code, {key('city', 'state_code')} as city_id
        from (select city, state_code from airports where iso_country = 'US'
              union select city, state_code from people)
        where city is not null""",
    "measured": f"""
        select cast(date_trunc('month', o_orderdate) as date) as dt, {CITY_NAME} as city, r_name as country,
               max(case when o_orderstatus <> 'P' then o_totalprice end) as avg_temp,
               max(c_acctbal) as std_temp, max(o_totalprice) as degrees
        from orders join residents on o_custkey = c_custkey group by all""",
    "positions": """
        select *, round(degrees / 1000, 1) * case when degrees >= 250000 then 1 else -1 end as latitude,
               round(degrees / 1000, 1) * case when degrees < 250000 then 1 else -1 end as longitude
        from measured""",
    "placed": f"""
        select avg_temp, std_temp, latitude, longitude, city_id, coalesce(n_states > 1, false) as ambiguous
        from (select * from positions
              where dt > date '{AFTER}' and country = '{COUNTRY}' and avg_temp is not null) as t
        left join (select *, count(*) over (partition by city) as n_states from city) as c on t.city = c.city""",
    "demographic_rows": """
        select floor(c_acctbal / 100) as median_age, c_acctbal as avg_household_size, c_name as race,
               cast(round(c_acctbal * 100) as bigint) as male_population,
               c_custkey as female_population, c_custkey * 7 as total_population,
               case when c_acctbal <= 9000 then c_custkey end as num_veterans,
               c_custkey * 3 as foreign_born, city_id, state_code
        from people join city using (city, state_code)""",
    "profile": """
        select state_code, avg(median_age) as median_age,
               cast(sum(total_population) as bigint) as total_population,
               cast(sum(foreign_born) as bigint) as foreign_born
        from (select city_id, state_code, max(median_age) as median_age,
                     max(total_population) as total_population, max(foreign_born) as foreign_born
              from demographic_rows group by all)
        group by all""",
    "persons": f"""
        select cast(o_orderkey as integer) as cicid, cast(o_custkey as integer) as from_country_code,
               cast(trunc(c_acctbal / 100) as integer) as age, n_regionkey as visa_code, n_name as visa_post,
               o_orderpriority as occupation, c_mktsegment as visa_type,
               cast(year(o_orderdate) - 30 as integer) as birth_year, o_orderstatus as gender,
               {MONTH_OF} as i94_dt
        from orders join residents on o_custkey = c_custkey""",
    "trips": f"""
        select cast(o_orderkey as integer) as cicid, r_name as iata_code,
               case when o_orderstatus = 'P' then null when c_acctbal < 0 then '99' else n_name end as state_code,
               o_orderpriority as airline, o_orderkey * 1000 + 7 as admnum, cast(o_custkey as varchar) as fltno,
               o_orderstatus as entdepa, nullif(o_orderstatus, 'P') as entdepd, cast(null as varchar) as entdepu,
               case when o_orderstatus = 'F' then 'M' end as matflag,
               cast(o_orderdate as date) as arrival_date,
               case when o_orderstatus <> 'P' then cast(o_orderdate as date) + 14 end as departure_date,
               case when o_orderstatus <> 'O' then cast(o_orderdate as date) end as deadline_departure,
               {MONTH_OF} as i94_dt
        from orders join residents on o_custkey = c_custkey""",
    "mart": """
        select p.cicid, p.age, p.occupation, p.gender, c.c_name as from_country, lower(n.n_name) as state,
               f.median_age, f.total_population, f.foreign_born, p.i94_dt
        from persons p join trips t on p.cicid = t.cicid and p.i94_dt = t.i94_dt
        join profile f on t.state_code = f.state_code
        left join customer c on p.from_country_code = c.c_custkey
        left join nation n on t.state_code = n.n_name""",
    "weather": """
        select name, elevation_ft, city.city, lower(n_name) as state, avg_temp, std_temp
        from airports left join city on airports.city = city.city and airports.state_code = city.state_code
        left join nation on n_name = city.state_code
        join placed on placed.city_id = city.city_id
        where iso_country = 'US'""",
    "towns": "select distinct city, state_code, true as has_airport from airports",
    "by_month": f"select o_orderkey, o_custkey, o_totalprice, {MONTH_OF} as i94_dt from orders",
    "month_counts": "select i94_dt, count(*) as n_rows from by_month group by all",
}


def _with(body: str) -> str:
    return "with " + ",\n".join(f"{name} as ({text})" for name, text in PARTS.items()) + "\n" + body


# Rows per table and month; a month whose mart is empty fails.
MONTHLY = """, months as (select distinct i94_dt from persons),
tables as (
    select 'immigrant' as "table", 10 as n_cols, i94_dt from persons
    union all select 'immigration', 14, i94_dt from trips
    union all select 'immigration_demographic', 10, i94_dt from mart
),
names as (select * from (values ('immigrant', 10), ('immigration', 14), ('immigration_demographic', 10)) n("table", n_cols)),
per_month as (
    select n."table", m.i94_dt, n.n_cols, count(t.i94_dt) as n_rows,
        case when count(t.i94_dt) > 0 then 'SUCCESS' else 'FAIL' end as status
    from months m cross join names n left join tables t on t.i94_dt = m.i94_dt and t."table" = n."table"
    group by n."table", m.i94_dt, n.n_cols
)"""

SQL = {
    "surrogate_key": f"""
        select *, {key('c_mktsegment', 'c_nationkey')} as pair_id
        from (select distinct c_mktsegment, c_nationkey from customer)""",
    "suffix": "select c_custkey, cast(c_nationkey as varchar) as state_code from customer",
    "pair_split": _with("select ident, pair_first as first, pair_second as second from airports"),
    "hemisphere_degrees": _with(
        'select dt, city as "City", country as "Country", latitude, longitude from positions'
    ),
    "epoch_days_to_date": """
        select o_orderkey,
               case o_orderstatus
                 when 'F' then cast(o_orderdate as date)
                 when 'O' then date '1960-01-01' - cast(date_diff('day', date '1960-01-01', cast(o_orderdate as date)) as integer)
               end as day
        from orders""",
    "text_to_date": f"""
        select o_orderkey, cast(try_strptime(case o_orderstatus when 'O' then 'D/S'
                 when 'P' then '0230' || right({DIGITS}, 4) else {DIGITS} end, '%m%d%Y') as date) as day
        from orders""",
    "month_key": _with("select * from month_counts"),
    "typed_projection": """
        select l_orderkey as order_id, l_linenumber, lower(l_returnflag) as flag,
               cast(round(l_tax * 100) as integer) as percent,
               cast(trunc(l_quantity) as integer) as quantity,
               cast(trunc(l_extendedprice) as bigint) as price, 'lines' as tag
        from lineitem""",
    "filter_stack": """
        select o_orderkey, o_custkey, o_totalprice from orders
        where o_orderstatus = 'F' and o_orderdate > timestamp '1996-01-01' and o_totalprice is not null""",
    "partition_scan": _with(f"select * from by_month where i94_dt = '{MONTH}'"),
    "partition_rewrite": _with("select * from month_counts"),
    "partition_append": _with(
        f"select i94_dt, case when i94_dt = '{MONTH}' then 2 * n_rows else n_rows end as n_rows from month_counts"
    ),
    "full_refresh": "select * from part",
    "csv_comma": "select * from customer",
    "csv_semicolon": "select * from part",
    "format_source": f"""
        select o_orderkey, o_custkey, case when o_orderstatus = 'O' then 'D/S' else {DIGITS} end as dtaddto,
               case when o_orderstatus <> 'P' then case when c_acctbal < 0 then '99' else n_name end end as i94addr, {MONTH_OF} as i94_dt
        from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey""",
    "two_key_left": _with(
        "select p.city, p.state_code, c_custkey, has_airport from people p left join towns t "
        "on p.city = t.city and p.state_code = t.state_code"
    ),
    "two_key_inner": _with(
        "select p.city, p.state_code, c_custkey, has_airport from people p join towns t "
        "on p.city = t.city and p.state_code = t.state_code"
    ),
    "fanout_left": _with(
        "select p.city, c_custkey, p.state_code, t.state_code as town_state "
        "from people p left join towns t on p.city = t.city"
    ),
    "code_lookup": """
        select case when c_acctbal < 0 then '99' else n_name end as state_code, c_custkey,
               case when c_acctbal >= 0 then lower(n_name) end as state
        from customer join nation on c_nationkey = n_nationkey""",
    "fact_fact": _with(
        "select p.cicid, p.i94_dt, p.age, t.state_code, t.departure_date from persons p "
        "left join (select * from trips where entdepd is not null) t on p.cicid = t.cicid and p.i94_dt = t.i94_dt"
    ),
    "union_distinct_by_name": """
        select s_name as place, s_nationkey as nation from supplier
        union select c_mktsegment, c_nationkey from customer""",
    "group_stats": """
        select c_nationkey, avg(round(c_acctbal * 100)) as mean_cents, sum(round(c_acctbal * 100)) as sum_cents,
               cast(sum(c_custkey) as bigint) as sum_keys
        from customer group by all""",
    "per_key_then_group": """
        select o_orderpriority, avg(mean_quantity) as mean_quantity, cast(sum(sum_cents) as bigint) as sum_cents
        from (select l_orderkey, max(l_quantity) as mean_quantity,
                     max(cast(round(l_extendedprice * 100) as bigint)) as sum_cents
              from lineitem group by all)
        join orders on o_orderkey = l_orderkey group by all""",
    "key_left": _with(
        "select city_id, ident as icao_code, c.city, c.state_code from airports a "
        "left join city c on a.city = c.city and a.state_code = c.state_code where iso_country = 'US'"
    ),
    "key_inner": _with(
        "select c.city_id, ident as icao_code, avg_temp, std_temp from airports a "
        "join city c on a.city = c.city and a.state_code = c.state_code "
        "join placed on placed.city_id = c.city_id where iso_country = 'US'"
    ),
    "country_lookup": _with(
        "select from_country_code, cicid, i94_dt, case when c_acctbal >= 0 then c_name end as from_country "
        "from persons left join customer on c_custkey = from_country_code"
    ),
    "known_states": _with(
        "select state_code, cicid, i94_dt, median_age, total_population, foreign_born "
        "from trips join profile using (state_code)"
    ),
    "city_dim": _with("select * from city"),
    "code_table": "select cast(c_custkey as integer) as code, c_name as country from customer",
    "airport_dim": _with(
        "select ident as icao_code, type, name, elevation_ft, iata_code, pair_first as airport_latitude, "
        "pair_second as airport_longitude, city_id from airports a "
        "left join city c on a.city = c.city and a.state_code = c.state_code where iso_country = 'US'"
    ),
    "city_demographics": _with("select * exclude (state_code) from demographic_rows"),
    "city_temperatures": _with("select avg_temp, std_temp, city_id from placed"),
    "city_temperatures_flagged": _with("select * from placed"),
    "airport_weather": _with("select * from weather"),
    "immigrant": _with("select * from persons"),
    "immigration": _with("select * from trips"),
    "state_profile": _with("select * from profile"),
    "state_profile_per_row": _with(
        "select state_code, avg(median_age) as median_age, "
        "cast(sum(total_population) as bigint) as total_population, "
        "cast(sum(foreign_born) as bigint) as foreign_born from demographic_rows group by all"
    ),
    "monthly_mart": _with("select * from mart"),
    "quality_report": """
        select "table", n_cols, n_rows, case when n_rows > 0 then 'SUCCESS' else 'FAIL' end as status
        from (select 'orders' as "table", 6 as n_cols, count(*) as n_rows from orders
              union all select 'lineitem', 11, count(*) from lineitem
              union all select 'customer', 5, count(*) from customer
              union all select 'unknown_orders', 6, count(*) from orders where o_orderstatus = 'X')""",
    "month_quality": _with(
        f"""select "table", i94_dt, 4 as n_cols, n_rows, case when n_rows > 0 then 'SUCCESS' else 'FAIL' end as status
        from (select t as "table", m as i94_dt, (select count(*) from by_month
                      where i94_dt = m and (t = 'orders' or o_totalprice < 0)) as n_rows
              from (values ('{MONTH}'), ('feb96'), ('jan16')) months(m), (values ('orders'), ('unfinished')) tables(t))"""
    ),
    "key_quality": _with(
        """select "table", n_rows, n_keys, case when n_rows = n_keys then 'SUCCESS' else 'FAIL' end as status
        from (select 'orders' as "table", count(*) as n_rows, count(distinct o_orderkey) as n_keys from orders
              union all select 'lineitem', count(*), count(distinct l_orderkey) from lineitem
              union all select 'city', count(*), count(distinct city_id) from city)"""
    ),
    "differing_figures": f"""
        with figures as (
            select {CITY_NAME} as city, n_name, floor(c_acctbal / 100) as age, c_custkey * 7 as population,
                case when c_acctbal <= 9000 then c_custkey end as veterans from customer join nation on c_nationkey = n_nationkey
        ),
        per_key as (
            select min(age) <> max(age) as a, min(population) <> max(population) as p,
                coalesce(min(veterans) <> max(veterans), false) or (count(veterans) > 0 and count(veterans) < count(*)) as v
            from figures group by city, n_name
        ),
        counted as (
            select 'Median Age' as "column", count(*) as n_keys, count(*) filter (a) as n_differing from per_key
            union all select 'Total Population', count(*), count(*) filter (p) from per_key
            union all select 'Number of Veterans', count(*), count(*) filter (v) from per_key
            union all select 'Count', count(*), 0 from per_key
        )
        select *, case when n_differing = 0 then 'SUCCESS' else 'FAIL' end as status from counted""",
    "unread_texts": """
        select 'c_custkey' as "column", count(*) as n_texts, 0::bigint as n_unread from customer
        union all select 'flag', count(*), count(*) filter (c_acctbal < 0) from customer""",
    "dimension_refresh": _with("select * from weather"),
    "backfill": _with("select * from mart"),
    "backfill_in_parts": _with(f"{MONTHLY} select * from per_month"),
    "run_month": _with(
        f"""{MONTHLY} select * from per_month
        union all select "table" || ' again', i94_dt, n_cols, n_rows, status from per_month where i94_dt = '{MONTH}'"""
    ),
    "failed_month": _with(f"{MONTHLY} select *, true as stopped from per_month"),
    "row_format_month": _with("select * from trips"),
    "monthly_mart_per_row": _with(
        """select cicid, age, occupation, gender, from_country, state, p.median_age, p.total_population, p.foreign_born, i94_dt
        from mart join (select state_code, avg(median_age) as median_age, cast(sum(total_population) as bigint) as total_population,
            cast(sum(foreign_born) as bigint) as foreign_born from demographic_rows group by all) p on lower(p.state_code) = mart.state"""
    ),
    "mixed_key_types": """
        select case when c_custkey % 3 = 0 then 3 else c_nationkey end as nation, c_custkey, s_suppkey
        from customer left join supplier on case when c_custkey % 3 = 0 then 3 else c_nationkey end = s_nationkey""",
    "interrupted_publish": _with(
        f"""{MONTHLY}, fewer as (
            select "table", count(*) as n_rows from (
                select 'immigrant' as "table", cicid, i94_dt from persons union all select 'immigration', cicid, i94_dt from trips
                union all select 'immigration_demographic', cicid, i94_dt from mart)
            where i94_dt = '{MONTH}' and cicid % 2 = 0 group by all
        )
        select stage, "table", i94_dt, n_rows from per_month, (values ('before'), ('interrupted')) s(stage)
        union all select 'again', p."table", i94_dt, case when i94_dt = '{MONTH}' then coalesce(f.n_rows, 0) else p.n_rows end
        from per_month p left join fewer f using ("table")"""
    ),
    "backfill_restart": _with(
        f"""select 'first' as stage, i94_dt, count(*) as n_rows from persons group by all
        union all select 'one feed changed', i94_dt, count(*) from persons where i94_dt = '{MONTH}' and cicid % 2 = 0 group by all
        union all select 'a lookup changed', i94_dt, count(*) from persons where i94_dt <> '{MONTH}' or cicid % 2 = 0 group by all"""
    ),
    "csv_headers": "select *, case when c_custkey % 3 = 2 then 'late' end as c_note from customer",
    "city_temperatures_by_position": _with(
        f""", cities as (select *, count(*) over (partition by city) as n_states from city),
        sites as (
            select c.city, c.city_id, {degrees('elevation_ft', 1, 90)} as latitude, {degrees('elevation_ft', 7, 180)} as longitude
            from airports a join city c on a.city = c.city and a.state_code = c.state_code where iso_country = 'US'
        ),
        points as (
            select dt, city, avg_temp, std_temp, {degrees('std_temp', 1, 90)} as latitude, {degrees('std_temp', 7, 180)} as longitude
            from measured where dt > date '{AFTER}' and country = '{COUNTRY}' and avg_temp is not null
        ),
        apart as (
            select p.dt, p.city, s.city_id, abs(p.latitude - s.latitude) as north,
                abs(p.longitude - s.longitude - 360 * floor((p.longitude - s.longitude + 180) / 360)) as east, p.latitude
            from points p join sites s on p.city = s.city
        ),
        nearest as (
            select dt, city, arg_min(city_id, row(north * north + pow(cos(radians(latitude)) * east, 2), city_id)) as city_id
            from apart where north <= 25 and east <= 25 group by dt, city
        ),
        single as (select city, max(city_id) as city_id, max(n_states) as n_states from cities group by city)
        select avg_temp, std_temp, latitude, longitude, coalesce(n.city_id, case when n_states = 1 then s.city_id end) as city_id,
            coalesce(n.city_id is null and n_states > 1, false) as ambiguous
        from points p left join nearest n on p.dt = n.dt and p.city = n.city left join single s on p.city = s.city"""
    ),
    "city_temperatures_latest": _with(
        f"""select avg_temp, std_temp, city_id from (
            select * from measured where country = '{COUNTRY}' and avg_temp is not null
            qualify row_number() over (partition by city order by dt desc, avg_temp desc, std_temp desc) = 1
        ) m left join city c on m.city = c.city"""
    ),
    "key_collisions": """
        select c_mktsegment, count(*) as n_pairs, count(*) as n_keys, 0::bigint as n_outside, 0::bigint as n_moved, 0::bigint as n_differing
        from (select distinct c_mktsegment, c_nationkey from customer) group by all""",
    "orphan_report": _with(
        """, links as (
            select 'city.state_code in state_code' as reference, state_code as key, state_code in (select n_name from nation where n_name <> 'FRANCE') as there from city
            union all select 'airport_code.city_id in city', cast(c.city_id as varchar), true
                from airports a left join city c on a.city = c.city and a.state_code = c.state_code where iso_country = 'US'
            union all select 'us_cities_demographics.city_id in city', cast(city_id as varchar), true from demographic_rows
            union all select 'us_cities_temperatures.city_id in city', cast(city_id as varchar), true from placed
            union all select 'us_airports_weather.city in city', city, true from weather
            union all select 'immigrant.from_country_code in country_code', cast(from_country_code as varchar),
                from_country_code in (select c_custkey from customer where c_acctbal >= 0) from persons where cicid % 5 <> 0
            union all select 'immigration.state_code in state_code', state_code, state_code in (select n_name from nation where n_name <> 'FRANCE') from trips
            union all select 'immigration.cicid+i94_dt in immigrant', cicid || i94_dt, cicid % 5 <> 0 from trips
            union all select 'immigration_demographic.cicid+i94_dt in immigrant', cicid || i94_dt, cicid % 5 <> 0 from mart
        ),
        counted as (
            select reference, count(*) as n_rows, count(*) filter (key is null) as n_null, count(*) filter (key is not null and not there) as n_orphans,
                count(distinct key) filter (key is not null and not there) as n_orphan_keys
            from links group by reference
        )
        select *, case when n_orphans = 0 then 'SUCCESS' else 'FAIL' end as status from counted"""
    ),
    "hot_right_side": """
        select c_custkey, c_name, o_orderkey from customer
        left join orders on c_custkey = case when o_orderkey % 3 = 0 then 1 else o_custkey end""",
    "exact_key_types": """
        select cast(cast(12345678901234567000 as hugeint) + a.c_custkey as varchar) as number, a.c_custkey, b.c_custkey as before
        from customer a left join (select * from customer where c_nationkey < 13) b on a.c_custkey = b.c_custkey + 1""",
}
