"""Independent SQL formulation of every registered query, for DuckDB.

Used as the correctness oracle: the driver (and ``tests/``) run each string
on the same parquet tables and compare with the Spark result.  The SQL is
written on its own terms -- window functions for shares, list functions for
request parsing -- and shares only the *inputs* with the Spark side: the fact
projections of the test tables, the request fixture and the fixed lookups.
"""

from __future__ import annotations

from adinsight.sources import dims
from testbed.projections import TESTDATA_PROJECTIONS
from testbed.fixtures import REQUEST_ROWS

MEAS = "impressions, clicks, conversions"
SUMS = ("CAST(SUM(impressions) AS BIGINT) AS impressions, "
        "CAST(SUM(clicks) AS BIGINT) AS clicks, "
        "CAST(SUM(conversions) AS BIGINT) AS conversions")
RAW_SUMS = ("CAST(SUM(impressions) AS BIGINT) AS impressions, "
            "CAST(SUM(clicks) AS BIGINT) AS clicks, "
            "CAST(SUM(pcconversions + pvconversions) AS BIGINT) AS conversions")


def _lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, (int, float)):
        return str(v)
    return "'" + str(v).replace("'", "''") + "'"


def _values(rows, names) -> str:
    body = ", ".join("(" + ", ".join(_lit(v) for v in r) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {body}) AS t({', '.join(names)})"


def _ids(col: str, distinct: bool = True) -> str:
    """Id text -> order-preserving distinct BIGINT list; NULL for NA/empty."""
    t = f"trim({col})"
    parsed = (f"list_filter(list_transform(string_split(replace({t}, '|', ','), ','), "
              f"lambda x: TRY_CAST(trim(x) AS BIGINT)), lambda x: x IS NOT NULL)")
    dedup = f"list_filter({parsed}, lambda x, i: list_position({parsed}, x) = i)"
    return f"CASE WHEN {col} IS NULL OR {t} IN ('', 'NA') THEN NULL ELSE {dedup if distinct else parsed} END"


def _text(col: str) -> str:
    return f"CASE WHEN {col} IS NULL OR trim({col}) IN ('', 'NA') THEN NULL ELSE trim({col}) END"


def _scope(fact: str, *, io=True, pixel=True, dates=True, tz=False, country=False,
           requests: str = "served") -> str:
    conds = ["f.advertiser_id = k.advertiser_id"]
    if dates:
        conds.append("f.dt BETWEEN k.from_dt AND k.to_dt")
    if io:
        conds.append("(k.io_ids IS NULL OR list_contains(k.io_ids, f.insertion_order_id))")
    if pixel:
        conds.append("(k.conv_pixel_ids IS NULL OR f.pixel_id = 0 "
                     "OR list_contains(k.conv_pixel_ids, f.pixel_id))")
    if tz:
        conds.append("f.time_zone_name = k.timezone")
    if country:
        conds.append("EXISTS (SELECT 1 FROM countries c WHERE c.timezone = k.timezone "
                     "AND c.de_country_name = f.de_country_name)")
    extra = ", k.timezone AS timezone" if country else ""
    return (f"SELECT k.request_id, f.*{extra} FROM {fact} f "
            f"JOIN (SELECT r.*, UNNEST(r.advertiser_ids) AS advertiser_id FROM {requests} r) k "
            f"ON {' AND '.join(conds)}")


def _complete(src: str, cols: list[str]) -> str:
    return f"SELECT * FROM {src} WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in cols)


def _metrics(src: str, dims_: list[str], part: list[str] | None = None) -> str:
    w = "PARTITION BY " + ", ".join(part or ["request_id"])

    def share(c):
        tot = f"SUM({c}) OVER ({w})"
        return f"CASE WHEN {tot} = 0 THEN CAST(0 AS DOUBLE) ELSE {c} * 100 / CAST({tot} AS DOUBLE) END"

    def ratio(c):
        return ("CASE WHEN impressions = 0 THEN CAST(0 AS DOUBLE) "
                f"ELSE {c} * 100 / CAST(impressions AS DOUBLE) END")

    d = ", ".join(dims_)
    return (f"SELECT request_id, {d}, impressions, {share('impressions')} AS Percentage_Impression_share, "
            f"clicks, {share('clicks')} AS Percentage_Click_share, {ratio('clicks')} AS Percentage_CTR, "
            f"conversions, {share('conversions')} AS Percentage_Conversion_share, "
            f"{ratio('conversions')} AS Percentage_CVR FROM {src}")


def _ctes() -> list[tuple[str, str]]:
    c: list[tuple[str, str]] = []
    add = lambda name, sql: c.append((name, sql))

    # -- inputs ---------------------------------------------------------------
    add("req_raw", _values(REQUEST_ROWS, [
        "sheet_row", "Advertiser_ID", "Insertion_Order_ID", "Conversion_Pixel_ID",
        "Segment_Pixel_ID", '"From_Date(YYYY-MM-DD)"', '"To_Date(YYYY-MM-DD)"', "Timezone",
        "Insight_Flag", "To_email_address"]))
    for name, (table, exprs) in TESTDATA_PROJECTIONS.items():
        add(f"f_{name}", f"SELECT {', '.join(exprs)} FROM {table}")
    add("days", _values([(i, n, dims.DAY_ORDER.index(n) + 1) for i, n in enumerate(dims.DAY_NAMES)],
                        ["dw", "day_name", "day_order"]))
    add("devices", _values(dims.DEVICE_CLASSES, ["device_type", "device_types"]))
    add("countries", _values(dims.COUNTRIES, ["timezone", "de_country_name"]))
    au, nz = dict(dims.AU_CODES), dict(dims.NZ_CODES)
    add("region_map", _values(
        [("AEST", k, v, au[v]) for k, v in dims.AU_REGIONS]
        + [("NZST", k, v, nz[v]) for k, v in dims.NZ_REGIONS],
        ["timezone", "region_key", "regions", "region_code"]))

    # -- requests ---------------------------------------------------------------
    add("req", f"""SELECT CAST(sheet_row AS BIGINT) AS request_id, sheet_row,
        {_ids('Advertiser_ID')} AS advertiser_ids,
        {_ids('Insertion_Order_ID')} AS io_ids,
        {_ids('Conversion_Pixel_ID')} AS conv_pixel_ids,
        {_ids('Segment_Pixel_ID')} AS seg_pixel_ids,
        {_ids('Advertiser_ID', distinct=False)} AS advertiser_list,
        {_ids('Insertion_Order_ID', distinct=False)} AS io_list,
        {_ids('Conversion_Pixel_ID', distinct=False)} AS conv_pixel_list,
        {_ids('Segment_Pixel_ID', distinct=False)} AS seg_pixel_list,
        TRY_CAST({_text('"From_Date(YYYY-MM-DD)"')} AS DATE) AS from_dt,
        TRY_CAST({_text('"To_Date(YYYY-MM-DD)"')} AS DATE) AS to_dt,
        {_text('Timezone')} AS timezone,
        Insight_Flag AS flag,
        COALESCE(contains(Insight_Flag, 'Yes'), false) AS pending,
        trim(To_email_address) AS to_email
        FROM req_raw""")
    add("req_p", """SELECT *, CASE WHEN COALESCE(len(advertiser_ids) > 0, false)
        AND from_dt IS NOT NULL AND to_dt IS NOT NULL THEN 'ok' ELSE 'invalid' END AS status FROM req""")
    add("served", "SELECT * FROM req_p WHERE pending")
    add("served_first", "SELECT * FROM served WHERE sheet_row = (SELECT MIN(sheet_row) FROM served)")

    # -- scoped facts -----------------------------------------------------------
    add("sc_ph", _scope("f_placement_hour", tz=True))
    add("sc_inv", _scope("f_inventory"))
    add("sc_sys", _scope("f_system"))
    add("sc_geo", _scope("f_geo", country=True))

    # -- extracts (raw = the aggregate query; x_ = after complete cases) -------
    add("xr_tod", f"SELECT request_id, day_hour, CAST(dayofweek(dt) AS INTEGER) AS dw, {RAW_SUMS} "
                  "FROM sc_ph GROUP BY ALL")
    add("xr_site", f"SELECT request_id, site_domain, {RAW_SUMS} FROM sc_inv GROUP BY ALL")
    add("xr_device", f"SELECT request_id, device_type, {RAW_SUMS} FROM sc_sys GROUP BY ALL")
    add("xr_os", f"SELECT request_id, device_type, os_name, {RAW_SUMS} FROM sc_sys GROUP BY ALL")
    add("xr_browser", f"SELECT request_id, device_type, browser_name, {RAW_SUMS} FROM sc_sys GROUP BY ALL")
    add("xr_size", f"SELECT request_id, width, height, {RAW_SUMS} FROM sc_sys GROUP BY ALL")
    add("xr_city", f"SELECT request_id, timezone, de_city AS city, de_region_name AS region, {RAW_SUMS} "
                   "FROM sc_geo GROUP BY ALL")
    add("xr_postcode", f"SELECT request_id, timezone, de_city AS city, de_region_name AS region, "
                       f"postal_code, {RAW_SUMS} FROM sc_geo GROUP BY ALL")
    m = ["impressions", "clicks", "conversions"]
    for x, keys in {"tod": ["day_hour", "dw"], "site": ["site_domain"], "device": ["device_type"],
                    "os": ["device_type", "os_name"], "browser": ["device_type", "browser_name"],
                    "size": ["width", "height"], "city": ["city", "region"],
                    "postcode": ["city", "region", "postal_code"]}.items():
        add(f"x_{x}", _complete(f"xr_{x}", keys + m))

    # -- labels -----------------------------------------------------------------
    add("l_tod", "SELECT t.*, d.day_name, d.day_order FROM x_tod t JOIN days d ON t.dw = d.dw")
    add("l_device", "SELECT x.*, d.device_types FROM x_device x JOIN devices d USING (device_type)")
    add("l_os", "SELECT x.*, d.device_types FROM x_os x JOIN devices d USING (device_type)")
    add("l_browser", "SELECT x.*, d.device_types FROM x_browser x JOIN devices d USING (device_type)")
    for g in ("city", "postcode"):
        add(f"l_{g}", f"""SELECT x.*, m.regions, m.region_code FROM x_{g} x LEFT JOIN region_map m
            ON m.timezone = x.timezone
            AND m.region_key = CASE WHEN x.timezone = 'NZST' THEN lower(x.region) ELSE x.region END""")

    # -- sheets -----------------------------------------------------------------
    wk = ", ".join(_lit(d) for d in dims.WEEKDAYS)
    we = ", ".join(_lit(d) for d in dims.WEEKEND)
    add("s_tod_weekday", _metrics(f"(SELECT request_id, day_hour, {SUMS} FROM l_tod WHERE day_hour > 6 "
                                  f"AND day_name IN ({wk}) GROUP BY ALL)", ["day_hour"]))
    add("s_tod_weekend", _metrics(f"(SELECT request_id, day_hour, {SUMS} FROM l_tod WHERE day_hour > 6 "
                                  f"AND day_name IN ({we}) GROUP BY ALL)", ["day_hour"]))
    add("s_dow", _metrics(f"(SELECT request_id, day_name, {SUMS} FROM l_tod GROUP BY ALL)", ["day_name"]))
    add("s_site", f"SELECT * FROM ({_metrics('x_site', ['site_domain'])}) "
                  "WHERE Percentage_Impression_share > 0.01")
    add("s_device", _metrics(f"(SELECT request_id, device_types, {SUMS} FROM l_device GROUP BY ALL)",
                             ["device_types"]))
    add("s_os", _metrics(f"(SELECT request_id, device_types, os_name, {SUMS} FROM l_os GROUP BY ALL)",
                         ["device_types", "os_name"], ["request_id", "device_types"]))
    add("s_browser", _metrics(f"(SELECT request_id, device_types, browser_name, {SUMS} "
                              "FROM l_browser GROUP BY ALL)",
                              ["device_types", "browser_name"], ["request_id", "device_types"]))
    add("s_size", _metrics("(SELECT request_id, CAST(width AS VARCHAR) || 'x' || CAST(height AS VARCHAR) "
                           f"AS size, {MEAS} FROM x_size)", ["size"]))
    city_g = (f"(SELECT request_id, lower(city) AS city, regions, region_code, {SUMS} "
              "FROM l_city GROUP BY ALL)")
    add("s_city", f"SELECT * FROM ({_metrics(city_g, ['city', 'regions', 'region_code'])}) "
                  "WHERE city IS NOT NULL AND regions IS NOT NULL")
    add("s_regions", _metrics(f"(SELECT request_id, regions, region_code, {SUMS} FROM l_city "
                              "WHERE regions IS NOT NULL GROUP BY ALL)", ["regions", "region_code"]))
    post_g = (f"(SELECT request_id, lower(city) AS city, regions, region_code, postal_code, "
              f"{SUMS} FROM l_postcode GROUP BY ALL)")
    add("s_postcode", f"SELECT * FROM ({_metrics(post_g, ['city', 'regions', 'region_code', 'postal_code'])}) "
                      "WHERE city IS NOT NULL AND regions IS NOT NULL")
    return c


SHEET_CTE = {
    "TOD_Weekday": "s_tod_weekday", "TOD_Weekend": "s_tod_weekend", "DOW": "s_dow",
    "Site_Domains": "s_site", "Device_type": "s_device", "Device_Os": "s_os",
    "Browser": "s_browser", "Creative_Size": "s_size", "City_Region": "s_city",
    "Regions": "s_regions", "City_postal_code": "s_postcode",
}


# Sheet order (total within a request), for the row numbers.
SHEET_ORDER_SQL = {
    "TOD_Weekday": "day_hour", "TOD_Weekend": "day_hour",
    "DOW": "CASE day_name " + " ".join(
        f"WHEN '{d}' THEN {i}" for i, d in enumerate(dims.DAY_ORDER)) + " END",
    "Site_Domains": "Percentage_Impression_share DESC, site_domain",
    "Device_type": "device_types", "Device_Os": "device_types, os_name",
    "Browser": "device_types, browser_name",
    "Creative_Size": "CAST(split_part(size, 'x', 1) AS INTEGER), CAST(split_part(size, 'x', 2) AS INTEGER)",
    "City_Region": "Percentage_Impression_share DESC, city, regions, region_code",
    "Regions": "region_code",
    "City_postal_code": "Percentage_Impression_share DESC, city, regions, region_code, postal_code",
}


def _report_long(first_only: bool = False, row_ids: bool = False) -> str:
    parts = []
    for sheet, cte in SHEET_CTE.items():
        src = f"(SELECT * FROM {cte} WHERE request_id IN (SELECT request_id FROM served_first))" \
            if first_only else cte
        rn = (f", ROW_NUMBER() OVER (PARTITION BY request_id ORDER BY {SHEET_ORDER_SQL[sheet]}) AS row_id"
              if row_ids else "")
        parts.append(f"SELECT '{sheet}' AS sheet, *{rn} FROM {src}")
    return " UNION ALL BY NAME ".join(parts)


def _with(body: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({s})" for n, s in _ctes()) + "\n" + body


def _ids_text(col: str) -> str:
    return f"array_to_string(list_sort({col}), ',')"


def _requests_overview(pending_only: bool) -> str:
    counts = []
    for fact, kw in (("placement_hour", {"tz": True}), ("inventory", {}), ("system", {}),
                     ("geo", {"country": True})):
        counts.append(f"(SELECT request_id, COUNT(*) AS n FROM ({_scope('f_' + fact, requests='req_p', **kw)}) "
                      f"GROUP BY request_id) c_{fact}")
    src = "req_p" + (" WHERE pending" if pending_only else "")
    joins = " ".join(f"LEFT JOIN {c} USING (request_id)" for c in counts)
    return f"""SELECT request_id, sheet_row, {_ids_text('advertiser_ids')} AS advertiser_ids,
        {_ids_text('io_ids')} AS io_ids, {_ids_text('conv_pixel_ids')} AS conv_pixel_ids,
        {_ids_text('seg_pixel_ids')} AS seg_pixel_ids, from_dt, to_dt, timezone, flag, pending,
        to_email, status,
        CAST(COALESCE(c_placement_hour.n, 0) AS BIGINT) AS rows_placement_hour,
        CAST(COALESCE(c_inventory.n, 0) AS BIGINT) AS rows_inventory,
        CAST(COALESCE(c_system.n, 0) AS BIGINT) AS rows_system,
        CAST(COALESCE(c_geo.n, 0) AS BIGINT) AS rows_geo
        FROM (SELECT * FROM {src}) q {joins}"""


def _manifest_body() -> str:
    from adinsight.plans import report as K
    ids = lambda c: f"array_to_string({c}, ',')"
    greeting = _lit(K.MAIL_GREETING).replace("\n", "' || chr(10) || '")
    return f"""SELECT s.request_id, s.to_email AS "to", {_lit(K.MAIL_SUBJECT)} AS subject,
        {greeting} || COALESCE({ids('s.advertiser_list')}, '')
        || CASE WHEN s.io_ids IS NULL THEN '' ELSE {_lit(K.MAIL_IO)} || {ids('s.io_list')} END
        || {_lit(K.MAIL_FROM)} || COALESCE(CAST(s.from_dt AS VARCHAR), 'NA')
        || {_lit(K.MAIL_TO)} || COALESCE(CAST(s.to_dt AS VARCHAR), 'NA')
        || CASE WHEN s.conv_pixel_ids IS NULL THEN ''
                ELSE {_lit(K.MAIL_CONV_PIXEL)} || {ids('s.conv_pixel_list')} END
        || CASE WHEN s.seg_pixel_ids IS NULL THEN ''
                ELSE {_lit(K.MAIL_SEG_PIXEL)} || {ids('s.seg_pixel_list')} END
        AS body,
        COALESCE({ids('s.advertiser_list')}, '') || {_lit(K.REPORT_SUFFIX)} AS report_name,
        s.status, CAST(COALESCE(n.report_rows, 0) AS BIGINT) AS report_rows
        FROM served s LEFT JOIN (SELECT request_id, COUNT(*) AS report_rows FROM ({_report_long()})
        GROUP BY request_id) n USING (request_id)"""


def oracle_queries() -> dict[str, str]:
    q: dict[str, str] = {}
    # sheets
    for key, cte in {
        "sheet_tod_weekday": "s_tod_weekday", "sheet_tod_weekend": "s_tod_weekend",
        "sheet_dow": "s_dow", "sheet_site_domains": "s_site",
        "sheet_device_type": "s_device", "sheet_device_os": "s_os", "sheet_browser": "s_browser",
        "sheet_creative_size": "s_size", "sheet_city_region": "s_city",
        "sheet_regions": "s_regions", "sheet_city_postcode": "s_postcode",
    }.items():
        q[key] = _with(f"SELECT * FROM {cte}")
    # extracts (raw aggregate as sent to the warehouse) and complete cases
    for x in ("tod", "site", "device", "os", "browser", "size", "city", "postcode"):
        q[f"extract_{x}"] = _with(f"SELECT * FROM xr_{x}")
    q["complete_cases"] = _with("SELECT * FROM x_postcode")
    # scoping predicates, one at a time on top of the advertiser key
    off = dict(io=False, pixel=False, dates=False)
    q["scope_advertiser"] = _with(_scope("f_system", **off))
    q["scope_insertion_order"] = _with(_scope("f_system", **{**off, "io": True}))
    q["scope_dates"] = _with(_scope("f_system", **{**off, "dates": True}))
    q["scope_pixel"] = _with(_scope("f_system", **{**off, "pixel": True}))
    q["scope_timezone"] = _with(_scope("f_placement_hour", **{**off, "tz": True}))
    q["scope_country"] = _with(_scope("f_geo", **{**off, "country": True}))
    q["scope_all"] = _with("SELECT * FROM sc_ph")
    # lookup joins
    q["join_day_name"] = _with("SELECT * FROM l_tod")
    q["join_weekday_semi"] = _with(f"SELECT * FROM l_tod WHERE day_name IN "
                                   f"({', '.join(_lit(d) for d in dims.WEEKDAYS)})")
    q["join_weekend_semi"] = _with(f"SELECT * FROM l_tod WHERE day_name IN "
                                   f"({', '.join(_lit(d) for d in dims.WEEKEND)})")
    q["join_device_class"] = _with("SELECT * FROM l_device")
    q["join_region_au"] = _with("SELECT * FROM l_city WHERE timezone = 'AEST'")
    q["join_region_nz"] = _with("SELECT * FROM l_city WHERE timezone = 'NZST'")
    # shares
    q["share_global"] = _with(_metrics("x_device", ["device_type"]))
    q["share_within_group"] = _with(_metrics("x_os", ["device_type", "os_name"],
                                             ["request_id", "device_type"]))
    # requests
    q["requests_parsed"] = _with(_requests_overview(False))
    q["requests_pending"] = _with(_requests_overview(True))
    q["requests_first"] = _with(_report_long(first_only=True))
    q["requests_claimed"] = _with(f"""SELECT r.sheet_row, r.Advertiser_ID, r.Insertion_Order_ID,
        r.Conversion_Pixel_ID, r.Segment_Pixel_ID, r."From_Date(YYYY-MM-DD)", r."To_Date(YYYY-MM-DD)",
        r.Timezone, CASE WHEN m.request_id IS NOT NULL THEN 'No' ELSE r.Insight_Flag END AS Insight_Flag,
        r.To_email_address, m.report_rows
        FROM req_raw r LEFT JOIN ({_manifest_body()}) m ON m.request_id = r.sheet_row""")
    # report
    q["report_long"] = _with(_report_long())
    q["report_row_ids"] = _with(_report_long(row_ids=True))
    q["delivery_manifest"] = _with(_manifest_body())
    return q
