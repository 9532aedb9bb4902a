"""Shared building blocks of the check SQL (DuckDB dialect)."""

FLIGHTS = """flights AS (
 WITH ap(idx, code, id) AS (VALUES (0,'ATL',10397),(1,'BOS',10721),(2,'CLT',11057),(3,'ORD',13930),(4,'CVG',11193),
  (5,'DFW',11298),(6,'DEN',11292),(7,'IAH',12266),(8,'LAX',12892),(9,'JFK',12478),(10,'SFO',14771),(11,'SEA',14747),
  (12,'DCA',11278),(13,'MIA',13303),(14,'PHX',14107),(15,'MSP',13487)),
 b AS (SELECT o_orderkey k, o_custkey c, CAST(o_orderdate AS DATE) AS FL_DATE,
   substr(o_orderpriority,1,1) OP_UNIQUE_CARRIER, CAST(floor(o_totalprice) AS BIGINT) % 220 p FROM orders)
 SELECT b.k AS FLIGHT_KEY, CAST(o.id AS INT) ORIGIN_AIRPORT_ID, o.code ORIGIN, concat(o.code,' CITY') ORIGIN_CITY_NAME,
  CAST(d.id AS INT) DEST_AIRPORT_ID, d.code DEST, concat(d.code,' CITY') DEST_CITY_NAME, b.FL_DATE,
  CAST(year(b.FL_DATE) AS INT) AS "YEAR", CAST(quarter(b.FL_DATE) AS INT) AS "QUARTER",
  CAST(month(b.FL_DATE) AS INT) AS "MONTH", CAST(day(b.FL_DATE) AS INT) AS DAY_OF_MONTH,
  CAST(isodow(b.FL_DATE) AS INT) AS DAY_OF_WEEK, b.OP_UNIQUE_CARRIER,
  concat(lpad(CAST((CAST(floor(b.k/16) AS BIGINT) % 4)*8 AS STRING),2,'0'), lpad(CAST((b.k*11) % 60 AS STRING),2,'0')) CRS_DEP_TIME,
  concat(lpad(CAST((CAST(floor(b.c/16) AS BIGINT) % 4)*8 AS STRING),2,'0'), lpad(CAST((b.c*7) % 60 AS STRING),2,'0')) CRS_ARR_TIME,
  CASE WHEN b.k % 37 = 0 THEN NULL ELSE CAST((b.k % 24)*100 + (b.k*11) % 60 AS DOUBLE) END DEP_TIME,
  CASE WHEN b.k % 37 = 0 THEN NULL ELSE CAST(b.p - 30 AS DOUBLE) END DEP_DELAY,
  CASE WHEN b.k % 41 = 0 THEN NULL ELSE CAST(b.p - 40 + b.c % 25 AS DOUBLE) END ARR_DELAY
 FROM b JOIN ap o ON o.idx = (b.k * 7) % 16 JOIN ap d ON d.idx = b.c % 16)"""

REPORTS = """reports AS (
 WITH ap(idx, code) AS (VALUES (0,'ATL'),(1,'BOS'),(2,'CLT'),(3,'ORD'),(4,'CVG'),(5,'DFW'),(6,'DEN'),(7,'IAH'),
  (8,'LAX'),(9,'JFK'),(10,'SFO'),(11,'SEA'),(12,'DCA'))
 SELECT l.l_shipdate + INTERVAL '1' HOUR * CAST((l.l_orderkey % 3)*8 AS INT) + INTERVAL '1' MINUTE * CAST(l.l_partkey % 60 AS INT) AS "DATE",
  CAST(0.0 AS DOUBLE) LATITUDE, CAST(0.0 AS DOUBLE) LONGITUDE, CAST(0.0 AS DOUBLE) ELEVATION, '' CIG,
  CASE WHEN ap.code IS NULL THEN '99999' ELSE concat('K', ap.code, ' ') END CALL_SIGN,
  CASE l.l_returnflag WHEN 'A' THEN 'FM-15' WHEN 'N' THEN 'FM-13' ELSE 'FM-12' END REPORT_TYPE,
  CASE WHEN l.l_linenumber = 7 THEN '+9999,9' ELSE concat(CASE WHEN (l.l_partkey*3) % 500 < 100 THEN '-' ELSE '+' END, lpad(CAST(abs((l.l_partkey*3) % 500 - 100) AS STRING),4,'0'), ',5') END TMP,
  CASE WHEN l.l_linenumber = 6 THEN '999,9,9,9999,9' ELSE concat(lpad(CAST(l.l_suppkey % 360 AS STRING),3,'0'), ',5,N,', lpad(CAST(l.l_partkey % 180 AS STRING),4,'0'), ',5') END WND,
  CASE WHEN l.l_partkey % 29 = 0 THEN '999999,9,N,9' ELSE concat(lpad(CAST((l.l_partkey*13) % 16093 AS STRING),6,'0'), ',5,N,5') END VIS,
  concat('+', lpad(CAST((l.l_partkey*2) % 250 AS STRING),4,'0'), ',5') DEW,
  concat(lpad(CAST(9900 + (l.l_orderkey % 400) AS STRING),5,'0'), ',5') SLP,
  CASE WHEN l.l_partkey % 11 = 0 THEN NULL ELSE concat(lpad(CAST(l.l_orderkey % 4 AS STRING),2,'0'), ',', lpad(CAST(CASE WHEN l.l_partkey % 10 < 8 THEN 0 ELSE CAST(l.l_quantity AS INT) END AS STRING),4,'0'), ',9,5') END AA1
 FROM lineitem l LEFT JOIN ap ON ap.idx = l.l_suppkey % 14)"""

CODES_SQL = "('ATL','BOS','CLT','ORD','CVG','DFW','DEN','IAH','LAX','JFK','SFO','SEA','DCA')"


def hour_ts(col: str) -> str:
    """Scheduled hour; NULL for an hour outside 0..23."""
    hh = f"TRY_CAST(substr({col},1,2) AS INT)"
    return (f"CASE WHEN {hh} BETWEEN 0 AND 23 THEN "
            f"CAST(make_date(\"YEAR\",\"MONTH\",DAY_OF_MONTH) AS TIMESTAMP) + INTERVAL 1 HOUR * {hh} END")


CLEAN = f"""clean AS (
 SELECT * FROM (SELECT *, round(DEP_TIME, 2) AS hour, {hour_ts('CRS_DEP_TIME')} AS sched_dep_hour,
   {hour_ts('CRS_ARR_TIME')} AS sched_arr_hour FROM flights WHERE ORIGIN IN {CODES_SQL} AND DEST IN {CODES_SQL})
 WHERE sched_dep_hour IS NOT NULL AND sched_arr_hour IS NOT NULL)"""

GOOD = """good AS (SELECT * FROM reports WHERE substr(CALL_SIGN,-4,3) <> '999'
 AND (REPORT_TYPE = 'FM-15' OR REPORT_TYPE = 'FM-13') AND split_part(AA1,',',4) = '5' AND split_part(TMP,',',2) = '5')"""

MEASURED = """measured AS (SELECT date_trunc('hour', "DATE") AS "time", substr(CALL_SIGN,-4,3) AS call_sign,
 CAST(split_part(TMP,',',1) AS DOUBLE)*9/50+32 AS temp_f,
 CAST(split_part(AA1,',',2) AS DOUBLE)/10 / nullif(CAST(split_part(AA1,',',1) AS DOUBLE),0) AS precip_mm,
 CAST(split_part(WND,',',4) AS DOUBLE)/10 AS wnd_mps, CAST(split_part(VIS,',',1) AS DOUBLE) AS vis_m,
 CAST(split_part(SLP,',',1) AS DOUBLE)/10 AS slp_hpa, CAST(split_part(DEW,',',1) AS DOUBLE)*9/50+32 AS dew_pt_f,
 split_part(WND,',',4) AS wnd_raw, split_part(VIS,',',1) AS vis_raw FROM good)"""

HOURLY = """hourly AS (SELECT "time", call_sign, avg(temp_f) AS avg_temp_f, sum(precip_mm) AS tot_precip_mm,
 avg(wnd_mps) AS avg_wnd_mps, avg(vis_m) AS avg_vis_m, avg(slp_hpa) AS avg_slp_hpa, avg(dew_pt_f) AS avg_dewpt_f
 FROM measured GROUP BY 1, 2)"""

MEASURE_COLS = ["avg_temp_f", "tot_precip_mm", "avg_wnd_mps", "avg_vis_m", "avg_slp_hpa", "avg_dewpt_f"]
SILVER_COLS = ["ORIGIN_AIRPORT_ID", "DEST_AIRPORT_ID", "DEP_DELAY", "ARR_DELAY", "FL_DATE", "DAY_OF_WEEK", "MONTH",
               "YEAR", "hour", "QUARTER", "DAY_OF_MONTH", *MEASURE_COLS]
SILVER_DOUBLES = {"DEP_DELAY", "ARR_DELAY", "hour", *MEASURE_COLS}
NUMERIC_COLS = [c for c in SILVER_COLS if c != "FL_DATE"]
_silver = ", ".join(f'"{c}"' for c in SILVER_COLS)
DEP = f"""dep AS (SELECT FLIGHT_KEY, {_silver} FROM clean JOIN hourly ON sched_dep_hour = "time" AND ORIGIN = call_sign)"""
ARR = f"""arr AS (SELECT FLIGHT_KEY, {_silver} FROM clean JOIN hourly ON sched_arr_hour = "time" AND DEST = call_sign)"""

def r(expr: str, alias: str | None = None) -> str:
    """A double to six places, as the Spark side is rounded."""
    return f'round(({expr}) + 1e-9, 6) AS "{alias or expr}"'


def settled(name: str, keep, measures=MEASURE_COLS) -> str:
    """Copy ``<name>6`` of a table with its measures to six places."""
    out = ", ".join(r(f'"{c}"', c) if c in measures else f'"{c}"' for c in keep)
    return f"{name}6 AS (SELECT {out} FROM {name})"


_CTES = {
    "flights": (FLIGHTS, []), "reports": (REPORTS, []), "clean": (CLEAN, ["flights"]), "good": (GOOD, ["reports"]),
    "measured": (MEASURED, ["good"]), "hourly": (HOURLY, ["measured"]),
    "dep": (DEP, ["clean", "hourly"]), "arr": (ARR, ["clean", "hourly"]),
    "hourly6": (settled("hourly", ["time", "call_sign", *MEASURE_COLS]), ["hourly"]),
    "dep6": (settled("dep", ["FLIGHT_KEY", *SILVER_COLS]), ["dep"]),
    "arr6": (settled("arr", ["FLIGHT_KEY", *SILVER_COLS]), ["arr"]),
}


def ctes(*names: str) -> str:
    """``WITH`` clause holding the named tables and all they need."""
    order = []

    def add(name):
        text, needs = _CTES[name]
        for need in needs:
            add(need)
        if text not in order:
            order.append(text)

    for name in names:
        add(name)
    return "WITH " + ",\n".join(order)


def cols(names, doubles=SILVER_DOUBLES) -> str:
    return ", ".join(r(f'"{c}"', c) if c in doubles else f'"{c}"' for c in names)
