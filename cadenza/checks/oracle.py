"""The queries in SQL over the sample tables, written without the engine's code."""

from __future__ import annotations

DAY = "20240130"
BEFORE = "20240129"
NEAR = "20240123"
FAR = "20231231"

_LINES = """
lines AS (
  SELECT *, strftime(DATE '2023-12-27'
           + CAST(date_diff('day', DATE '1995-01-02', CAST(l_shipdate AS DATE)) % 35 AS INTEGER),
           '%Y%m%d') AS dt
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
"""

_PLAYS = _LINES + """,
plays AS (
  SELECT CAST(l_partkey AS VARCHAR) AS songid, CAST(l_suppkey AS VARCHAR) AS mid,
         CASE WHEN l_linenumber <> 7 THEN CAST(o_custkey AS VARCHAR) END AS uid,
         CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS dur,
         'O' || CAST(l_orderkey // 8 AS VARCHAR) AS order_id, l_orderkey AS sid, dt,
         l_returnflag AS opt, l_linestatus AS cons, CAST(l_linenumber AS VARCHAR) AS pkg
  FROM lines)
"""

_PART = """
p AS (
  SELECT *, CASE WHEN p_partkey % 31 = 30 THEN '' ELSE CAST(p_partkey AS VARCHAR) END AS nbr,
         CAST(split_part(p_brand, '#', 2) AS INTEGER) * 100 + p_size AS singer
  FROM part)
"""

_SINGERS = """
         CASE WHEN p_partkey % 5 < 3 THEN 'Singer ' || singer ELSE '' END AS SINGER1,
         CASE WHEN p_partkey % 5 = 0 THEN 'Guest ' || p_size ELSE '' END AS SINGER2,
         CASE WHEN p_partkey % 5 < 3 THEN CAST(singer AS VARCHAR) ELSE '' END AS SINGER1ID,
         CASE WHEN p_partkey % 5 = 0 THEN CAST(p_size AS VARCHAR) ELSE '' END AS SINGER2ID
"""

_POST_TIME = """
         CASE p_partkey % 4
           WHEN 0 THEN strftime(DATE '2010-01-01' + CAST(p_partkey % 3000 AS INTEGER), '%Y-%m-%d')
                       || ' 03:04:05'
           WHEN 1 THEN strftime(TIMESTAMP '2020-01-02 03:04:05' + to_seconds(p_partkey),
                                '%Y-%m-%d %H:%M:%S')
           ELSE '' END
"""

_ALBUM = """
         CASE p_partkey % 6 WHEN 0 THEN 'Album ' || p_brand WHEN 1 THEN '《' || p_name || '》'
              WHEN 4 THEN NULL ELSE '暂无专辑' END
"""

# Columns of the song table that come through unchanged.
_TAIL = (
    "PINYIN_FST", "PINYIN", "SING_TYPE", "ORI_SINGER", "LYRICIST", "COMPOSER", "BPM_VAL",
    "STAR_LEVEL", "VIDEO_QLTY", "VIDEO_MK", "VIDEO_FTUR", "LYRIC_FTUR", "IMG_QLTY",
    "SUBTITLES_TYPE", "AUDIO_FMT", "ORI_SOUND_QLTY", "ORI_TRK", "ORI_TRK_VOL", "ACC_VER",
    "ACC_QLTY", "ACC_TRK_VOL", "ACC_TRK", "WIDTH", "HEIGHT", "VIDEO_RSVL", "SONG_VER",
)

_DIM = _PART + f""",
dim AS (
  SELECT nbr AS NBR, CASE WHEN p_size = 1 THEN 'other ' || p_name ELSE p_name END AS NAME,
         p_type AS SOURCE, {_ALBUM} AS ALBUM, p_brand AS PRDCT, 'L' || (p_size % 5) AS LANG,
         p_type AS VIDEO_FORMAT, p_size AS DUR, {_SINGERS}, 0 AS MAC_TIME,
         {_POST_TIME} AS POST_TIME,
         {", ".join(f"CAST(p_partkey % {n + 2} AS VARCHAR) AS {c}" for n, c in enumerate(_TAIL))},
         CASE (p_partkey // 4) % 4 WHEN 0 THEN 'Co ' || p_brand WHEN 1 THEN NULL
              ELSE '乐心曲库' END AS AUTH_CO,
         CAST(p_partkey % 2 AS VARCHAR) AS STATE,
         CASE (p_partkey // 2) % 4 WHEN 0 THEN p_size || ',9' WHEN 3 THEN CAST(p_size AS VARCHAR)
              END AS PRDCT_TYPE
  FROM p WHERE nbr <> '')
"""


def _window(first: str, prefix: str) -> str:
    return f"""
    count(*) FILTER (dt >= '{first}') AS {prefix}SING_CNT,
    count(DISTINCT uid) FILTER (dt >= '{first}') AS {prefix}USR_CNT,
    count(DISTINCT order_id) FILTER (dt >= '{first}') AS {prefix}ORDR_CNT
    """


_FEATURES = _PLAYS + "," + _DIM + f""",
cnt AS (
  SELECT songid, {_window(DAY, "")}, {_window(NEAR, "RCT_7_")}, {_window(FAR, "RCT_30_")}
  FROM plays WHERE dt BETWEEN '{FAR}' AND '{DAY}' GROUP BY songid),
daily AS (
  SELECT songid, dt, count(*) AS n FROM plays
  WHERE dt BETWEEN '{FAR}' AND '{BEFORE}' GROUP BY songid, dt),
peak AS (
  SELECT songid, max(CASE WHEN dt >= '{NEAR}' THEN n ELSE 0 END) AS near, max(n) AS far
  FROM daily GROUP BY songid),
ftur AS (
  SELECT NBR, NAME, SOURCE, ALBUM, PRDCT, LANG, VIDEO_FORMAT, DUR, SINGER1, SINGER2, SINGER1ID,
         SINGER2ID, MAC_TIME, SING_CNT, 0 AS SUPP_CNT, USR_CNT, ORDR_CNT,
         RCT_7_SING_CNT, 0 AS RCT_7_SUPP_CNT, coalesce(near, 0) AS RCT_7_TOP_SING_CNT,
         0 AS RCT_7_TOP_SUPP_CNT, RCT_7_USR_CNT, RCT_7_ORDR_CNT,
         RCT_30_SING_CNT, 0 AS RCT_30_SUPP_CNT, coalesce(far, 0) AS RCT_30_TOP_SING_CNT,
         0 AS RCT_30_TOP_SUPP_CNT, RCT_30_USR_CNT, RCT_30_ORDR_CNT
  FROM cnt JOIN dim ON songid = NBR LEFT JOIN peak USING (songid) WHERE SING_CNT > 0)
"""


def _ranked(source: str, keys: str, top: int | None) -> str:
    def recent(n):
        return (
            f"pow((ln(p{n} / {n} + 1) * 0.63 + ln(t{n} + 1) * 0.37) * 0.8, 2) * 10"
        )

    return f"""
, idx AS (
  SELECT '1' AS PERIOD, {keys}, pow(ln(p1 + 1) * 0.63 * 0.8, 2) * 10 AS v FROM {source}
  UNION ALL SELECT '7', {keys}, {recent(7)} FROM {source}
  UNION ALL SELECT '30', {keys}, {recent(30)} FROM {source}),
ranked AS (
  SELECT '{DAY}' AS data_dt, PERIOD, {keys}, round(v, 6) AS RSI,
         row_number() OVER (PARTITION BY PERIOD ORDER BY v DESC, {keys}) AS RSI_RANK
  FROM idx)
SELECT * FROM ranked {f"WHERE RSI_RANK <= {top}" if top else ""}
"""


_SONG_INDEX = "WITH " + _FEATURES + """,
src AS (
  SELECT NBR, NAME, CAST(SING_CNT AS DOUBLE) AS p1, CAST(RCT_7_SING_CNT AS DOUBLE) AS p7,
         CAST(RCT_7_TOP_SING_CNT AS DOUBLE) AS t7, CAST(RCT_30_SING_CNT AS DOUBLE) AS p30,
         CAST(RCT_30_TOP_SING_CNT AS DOUBLE) AS t30 FROM ftur)
"""
_SINGER_INDEX = "WITH " + _FEATURES + """,
src AS (
  SELECT SINGER1ID, SINGER1, CAST(sum(SING_CNT) AS DOUBLE) AS p1,
         CAST(sum(RCT_7_SING_CNT) AS DOUBLE) AS p7,
         CAST(sum(RCT_7_TOP_SING_CNT) AS DOUBLE) AS t7,
         CAST(sum(RCT_30_SING_CNT) AS DOUBLE) AS p30,
         CAST(sum(RCT_30_TOP_SING_CNT) AS DOUBLE) AS t30
  FROM ftur GROUP BY SINGER1ID, SINGER1)
"""

_LEDGER = f"""
ledger AS (
  SELECT CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS ID, 'T' || l_orderkey AS TRD_ID,
         CAST(o_custkey AS VARCHAR) AS UID, CAST(l_suppkey AS VARCHAR) AS MID, 2 AS PRDCD_TYPE,
         CASE WHEN l_linenumber <> 6 THEN CAST(o_orderkey % 2 AS INTEGER) END AS PAY_TYPE,
         dt || '120000' AS ACT_TM, CAST(l_linenumber % 2 AS INTEGER) AS PKG_ID,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS COIN_PRC, 1 AS COIN_CNT,
         dt || '120000' AS UPDATE_TM,
         CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderkey AS VARCHAR) END AS ORDR_ID,
         o_orderpriority AS ACTV_NM, CAST(l_extendedprice AS DECIMAL(18,2)) AS PKG_PRC,
         CAST(l_discount AS DECIMAL(4,2)) AS PKG_DSCNT, o_orderstatus AS CPN_TYPE,
         CASE WHEN l_returnflag = 'N' THEN 0 WHEN l_returnflag = 'R' THEN 2
              WHEN l_linestatus = 'F' THEN 1 ELSE 2 END AS ABN_TYP
  FROM lines WHERE dt = '{DAY}')
"""

_USERS = """
cu AS (
  SELECT c_custkey AS UID, CAST(c_custkey // 15 AS VARCHAR) AS REG_MID, 'acct' || c_custkey AS REF_UID,
         CASE c_custkey % 5 WHEN 0 THEN '0' WHEN 1 THEN '1' WHEN 2 THEN '2' WHEN 3 THEN '9' END AS GDR,
         '1990-01-' || lpad(CAST(c_custkey % 28 + 1 AS VARCHAR), 2, '0') AS BIRTHDAY,
         '139' || c_custkey AS MSISDN, c_nationkey AS LOC_ID,
         CAST(c_custkey % 3 AS VARCHAR) AS LOG_MDE,
         strftime(DATE '2020-01-01' + CAST(c_custkey % 1000 AS INTEGER), '%Y%m%d') AS REG_DT,
         '1530' || lpad(CAST(c_custkey % 60 AS VARCHAR), 2, '0') AS REG_TM,
         c_custkey % 500 AS USR_EXP, c_custkey % 70 AS SCORE,
         CAST(c_custkey % 9 AS INTEGER) AS LEVEL, c_mktsegment AS seg, c_nationkey AS nat
  FROM customer),
usr AS (
  SELECT UID, REG_MID, CASE seg WHEN 'FURNITURE' THEN '2' WHEN 'HOUSEHOLD' THEN '3' ELSE '1' END
           AS REG_CHNL, REF_UID, GDR, BIRTHDAY, MSISDN, LOC_ID, LOG_MDE, REG_DT, REG_TM, USR_EXP,
         SCORE, LEVEL, CASE WHEN seg = 'FURNITURE' AND UID % 2 = 0 THEN '1' ELSE '2' END AS USR_TYPE,
         CASE WHEN seg = 'FURNITURE' THEN CAST(UID % 2 AS VARCHAR) END AS IS_CERT,
         CASE WHEN seg = 'FURNITURE' THEN CAST(UID % 3 AS VARCHAR) END AS IS_STDNT
  FROM cu WHERE seg <> 'MACHINERY'
  UNION ALL
  SELECT UID, REG_MID, '4', REF_UID, GDR, BIRTHDAY, MSISDN, LOC_ID, NULL, REG_DT, REG_TM, USR_EXP,
         0, LEVEL, '2', NULL, NULL
  FROM cu WHERE seg = 'MACHINERY' OR nat = 7),
ev AS (
  SELECT *, CAST(props->>'$.k' AS INTEGER) AS k, strftime(ts, '%Y%m%d') AS dt FROM events),
act AS (
  SELECT usr.* EXCLUDE (UID), seen.UID, seen.dt
  FROM (SELECT DISTINCT user_id * 10 + k % 10 AS UID, dt FROM ev) seen
  LEFT JOIN usr ON usr.UID = seen.UID)
"""

_ADDRESS = """
place AS (
  SELECT *, CASE WHEN s_suppkey % 9 <> 8 THEN s_suppkey % 13 END AS form
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
addr AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS MID,
         CASE WHEN form IN (0, 12) THEN '内蒙古' WHEN form = 1 THEN '宁夏' WHEN form = 2 THEN '广西'
              WHEN form = 3 THEN '西藏' WHEN form IN (4, 5, 6) THEN '新疆' WHEN form = 7 THEN '北京'
              WHEN form IN (8, 9) THEN '重庆' WHEN form = 10 THEN '湖南' WHEN form = 11 THEN '云南'
              ELSE '' END AS province,
         CASE WHEN form IN (0, 1, 2, 4, 7, 8, 9, 10) THEN n_name
              WHEN form IN (5, 11) THEN n_name || '自治' WHEN form = 6 THEN n_name || '地'
              ELSE '' END AS city
  FROM place)
"""

_FORMS = (
    "('内蒙古自治区','市新城区'),('宁夏回族自治区','市兴庆区'),('广西壮族自治区','市青秀区'),"
    "('西藏自治区','市城关区'),('新疆维吾尔自治区','市天山区'),('新疆维吾尔自治区','自治州霍城县'),"
    "('新疆维吾尔自治区','地区温宿县'),('北京市','区'),('重庆市','区解放碑'),('重庆市','县'),"
    "('湖南省','市岳麓区'),('云南省','自治州祥云县'),('内蒙古自治区','盟')"
)

_MACHINES = _ADDRESS + f""",
form AS (
  SELECT row_number() OVER () - 1 AS form_no, a, b FROM (VALUES {_FORMS}) v(a, b)),
loc AS (
  SELECT addr.MID,
         CASE WHEN s_suppkey % 4 = 0 THEN r_name ELSE province END AS prvc,
         CASE WHEN s_suppkey % 4 = 0 THEN n_name ELSE city END AS cty,
         CASE WHEN s_suppkey % 5 <> 0 THEN a || n_name || b END AS addr_fmt,
         CASE s_suppkey % 3 WHEN 0 THEN '20200101000000' WHEN 1 THEN '20200101123000'
              ELSE '19700101000000' END AS rev_tm,
         CASE s_suppkey % 4 WHEN 0 THEN '20190101000000' WHEN 1 THEN '20190101010203'
              ELSE '19700101000000' END AS sale_tm
  FROM place JOIN addr ON addr.MID = CAST(s_suppkey AS VARCHAR)
  JOIN form ON form_no = s_suppkey % 13
  WHERE s_suppkey % 8 <> 5),
mac AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS MID, s_suppkey AS key, s_nationkey AS nat,
         s_nationkey <> 3 AS a, s_nationkey <> 5 AS b, s_name, n_name, r_name,
         CASE WHEN s_nationkey <> 11 THEN 'store ' || (s_suppkey // 5) END AS store,
         CASE WHEN s_nationkey <> 11 THEN s_suppkey // 5 END AS sk
  FROM place),
dimension AS (
  SELECT mac.MID, CASE WHEN b THEN s_name END AS MAC_NM,
         CASE WHEN a THEN 'v' || (key % 3) END AS SONG_WHSE_VER,
         CASE WHEN a THEN 'v' || (key % 3) END AS EXEC_VER,
         CASE WHEN a THEN 'v' || (key % 3) END AS UI_VER,
         CASE WHEN a THEN 'H' || key END AS HARD_ID,
         sale_tm AS SALE_TM, rev_tm AS REV_TM, store AS OPER_NM,
         coalesce(l.prvc, CASE WHEN b THEN r_name END) AS PRVC,
         coalesce(l.cty, CASE WHEN b THEN n_name END) AS CTY,
         CASE WHEN b AND key % 3 < 2 THEN n_name || ' area ' || (key % 3) END AS AREA,
         coalesce(addr_fmt, CASE WHEN b AND key % 6 <> 0 THEN 'scene ' || key || ' ground ' || key END)
           AS ADDR,
         store AS STORE_NM, 'tag ' || (sk % 4) AS SCENCE_CATGY, 'subcat ' || (sk % 6) AS SUB_SCENCE_CATGY,
         'subtag ' || (sk % 5) AS SCENE, 'subscene ' || (sk % 7) AS SUB_SCENE,
         'brand ' || (sk % 8) AS BRND, 'subbrand ' || (sk % 9) AS SUB_BRND,
         CASE WHEN b THEN CASE WHEN key % 5 = 0 THEN '联营版' ELSE 'std' END END AS PRDCT_NM,
         2 AS PRDCT_TYP,
         CASE WHEN b AND (key % 5 = 0 OR (key % 7 <> 0 AND key % 80 + 40 < 100)) THEN '联营'
              ELSE '卖断' END AS BUS_MODE,
         CASE WHEN b AND key % 7 <> 0 THEN CAST(key % 80 + 40 AS INTEGER) END AS INV_RATE,
         CASE WHEN b THEN CAST(key % 30 AS INTEGER) END AS AGE_RATE,
         CASE WHEN b THEN CAST(key % 20 AS INTEGER) END AS COM_RATE,
         CASE WHEN b AND key % 6 <> 0 THEN CAST(key % 10 AS INTEGER) END AS PAR_RATE,
         coalesce(CASE WHEN a AND key % 4 <> 0 THEN CAST(key % 2 AS INTEGER) END,
                  CASE WHEN b THEN CAST(key % 2 AS INTEGER) END) AS IS_ACTV,
         CASE WHEN b THEN CASE key % 3 WHEN 0 THEN '20210101000000' WHEN 1 THEN '20210101000001'
              ELSE '19700101000000' END END AS ACTV_TM,
         coalesce(CASE WHEN a AND key % 3 <> 0 THEN CAST(key % 2 AS INTEGER) END,
                  CASE WHEN b THEN CAST(key % 2 AS INTEGER) END) AS PAY_SW,
         store AS PRTN_NM, CASE WHEN a THEN '2024012' || (key % 10) || '101010' END AS CUR_LOGIN_TM
  FROM mac LEFT JOIN (SELECT * FROM loc WHERE prvc <> '' AND cty <> '') l ON mac.MID = l.MID)
"""

_POSITIONS = """
pos AS (
  SELECT DISTINCT user_id * 10 + CAST(props->>'$.k' AS INTEGER) % 10 AS UID, user_id + 5 AS mid,
         user_id % 25 AS nat,
         CASE event_type WHEN 'error' THEN '' WHEN 'signup' THEN NULL
           ELSE (user_id % 25 + 20) || CASE event_type WHEN 'click' THEN '.10' WHEN 'view' THEN '.20'
                ELSE '.30' END || CASE user_id % 25 % 6 WHEN 1 THEN '00006' WHEN 2 THEN '7'
                WHEN 4 THEN '15' WHEN 5 THEN '1' ELSE '' END END AS x,
         CASE WHEN event_type = 'error' THEN ''
           ELSE (user_id % 25 + 100) || CASE user_id % 25 % 6 WHEN 3 THEN '.2503'
                WHEN 1 THEN '.2499996' ELSE '.25' END
           END AS y
  FROM events),
best AS (
  SELECT mid, nat, x, y, cnt FROM (
    SELECT mid, nat, x, y, count(*) AS cnt,
           row_number() OVER (PARTITION BY mid
             ORDER BY count(*) DESC, x ASC NULLS FIRST, y ASC NULLS FIRST) AS rn
    FROM pos GROUP BY mid, nat, x, y)
  WHERE rn = 1 AND x <> '' AND y <> '')
"""

# Address columns that the sample answers leave empty.
_BLANKS = (
    "AD_CD", "TOWN_SHIP", "TOWN_CD", "NB_TP", "BD_NM", "BD_TP", "STREET_LOC", "STREET_DRCTION",
    "STREET_DSTANCE", "BUS_INFO",
)
_NO_FIELDS = ", ".join(f"'' AS {name}" for name in _BLANKS)

_LOCATIONS = _POSITIONS + f""",
fresh AS (
  SELECT CAST(mid AS INTEGER) AS MID, x AS X, y AS Y, CAST(cnt AS INTEGER) AS CNT,
         CASE WHEN nat % 6 = 4 THEN '2 Side Street, ' ELSE '1 Main Street, ' END || n_name AS ADDR, r_name AS PRVC, n_name AS CTY,
         CAST(n_nationkey AS VARCHAR) AS CTY_CD, n_name || ' district' AS DISTRICT,
         n_name || ' quarter' AS NB_NM,
         CASE WHEN nat % 6 = 4 THEN 'Side Street' ELSE 'Main Street' END AS STREET,
         CASE WHEN nat % 6 = 4 THEN '2' ELSE '1' END AS STREET_NB, {_NO_FIELDS}
  FROM best JOIN nation ON nat = n_nationkey JOIN region ON n_regionkey = r_regionkey
  WHERE nat < 23),
snapshot AS (
  SELECT * FROM fresh
  UNION ALL BY NAME
  SELECT CAST(s_suppkey AS INTEGER) AS MID, '10.5' AS X, '20.5' AS Y, 1 AS CNT,
         'site ' || s_name AS ADDR, 'old province' AS PRVC, 'old city ' || s_nationkey AS CTY,
         '' AS CTY_CD, 'old district' AS DISTRICT, '' AS NB_NM, '' AS STREET, '' AS STREET_NB,
         {_NO_FIELDS}
  FROM supplier WHERE s_suppkey NOT IN (SELECT MID FROM fresh))
"""

_STAT = ", ".join([_LINES, _LEDGER, _USERS, _MACHINES, _LOCATIONS]) + f""",
turnover AS (
  SELECT MID AS machine, PKG_ID, PAY_TYPE, PKG_ID IS NOT NULL AND PAY_TYPE IS NOT NULL AS keyed,
         count(DISTINCT UID) FILTER (ABN_TYP = 0) AS buyers,
         count(ORDR_ID) FILTER (ABN_TYP = 0) AS sales,
         sum(COIN_CNT * COIN_PRC) FILTER (ABN_TYP = 0) AS earned,
         count(DISTINCT UID) FILTER (ABN_TYP = 2) AS returners,
         count(ORDR_ID) FILTER (ABN_TYP = 2) AS returns,
         sum(COIN_CNT * COIN_PRC) FILTER (ABN_TYP = 2) AS paid_back
  FROM ledger GROUP BY ALL HAVING count(*) FILTER (ABN_TYP = 0) > 0),
joiners AS (
  SELECT REG_MID AS machine, count(UID) AS joined FROM act WHERE dt = '{DAY}' GROUP BY REG_MID),
site AS (SELECT MID AS place_id, PRVC AS site_prvc, CTY AS site_cty, DISTRICT AS site_area FROM snapshot),
stat AS (
  SELECT MID, MAC_NM, PRDCT_TYP, STORE_NM, BUS_MODE, PAY_SW, SCENCE_CATGY, SUB_SCENCE_CATGY,
         SCENE, SUB_SCENE, BRND, SUB_BRND, coalesce(site_prvc, PRVC) AS PRVC,
         coalesce(site_cty, CTY) AS CTY, coalesce(site_area, AREA) AS AREA, PRTN_NM AS AGE_ID,
         INV_RATE, AGE_RATE, COM_RATE, PAR_RATE, turnover.PKG_ID, turnover.PAY_TYPE,
         coalesce(buyers, 0) AS CNSM_USR_CNT, coalesce(joined, 0) AS NEW_USR_CNT,
         coalesce(sales, 0) AS REV_ORDR_CNT,
         CAST(coalesce(earned, 0) AS DECIMAL(38,4)) AS TOT_REV,
         CASE WHEN keyed THEN returners ELSE 0 END AS REF_USR_CNT,
         CASE WHEN keyed THEN returns ELSE 0 END AS REF_ORDR_CNT,
         CAST(CASE WHEN keyed THEN coalesce(paid_back, 0) ELSE 0 END AS DECIMAL(38,4)) AS TOT_REF
  FROM dimension
  LEFT JOIN turnover ON turnover.machine = MID
  LEFT JOIN joiners ON joiners.machine = MID
  LEFT JOIN site ON place_id = CAST(MID AS INTEGER))
"""


def _share(rate: str, name: str) -> str:
    return f"CAST(sum(TOT_REV * coalesce({rate}, 0)) AS DECIMAL(38,4)) AS {name}"


_MESSAGES = """
msg AS (
  SELECT ts, CAST(k AS VARCHAR) AS mid,
         CASE WHEN event_type <> 'error' THEN CAST(user_id AS VARCHAR) END AS uid,
         'song ' || (user_id % 97) AS songname, k
  FROM (SELECT *, CAST(props->>'$.k' AS INTEGER) AS k FROM events)
  WHERE k <> 98)
"""


def _windows(aggregate: str, key: str, where: str, length: int, slide: int) -> str:
    """Sliding windows of ``length`` seconds every ``slide`` seconds."""
    return f"""
win AS (
  SELECT time_bucket(to_seconds({slide}), ts, TIMESTAMP '1970-01-01')
           - to_seconds(CAST(i * {slide} AS BIGINT)) AS w, *
  FROM msg, generate_series(0, {length // slide - 1}) g(i) WHERE {where}),
found AS (
  SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start,
         strftime(w + to_seconds({length}), '%Y-%m-%d %H:%M:%S') AS window_end, {key}, {aggregate}
  FROM win GROUP BY w, {key})
"""


def _stream(aggregate, key, where, length, slide, result="SELECT * FROM found") -> str:
    return f"WITH {_MESSAGES}, {_windows(aggregate, key, where, length, slide)} {result}"


_TOP_SONGS = """
SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY times DESC, songname) AS rank
  FROM found) WHERE rank <= 30
"""

_ARRIVALS = _MESSAGES + """, timed AS (
  SELECT CASE WHEN k <> 99 THEN mid END AS mid, uid, songname,
         CAST(floor(epoch(ts)) AS BIGINT) - 1704067200 AS sec FROM msg),
parts AS (
  SELECT mid, uid, songname,
         greatest(0, least(2, (sec + (sec * 7919) % 6000 - 3000) // 864000)) AS part FROM timed
  UNION ALL SELECT 'end', 'end', 'end', 3),
arrived AS (SELECT * FROM parts JOIN range(4) r(shown) ON part IN (shown, shown - 1))
"""

_MINUTE, _WIDE, _HALF_HOUR = 60, 6 * 3600, 1800

_GOOD_PLAYS = "sid % 10 NOT IN (0, 1, 2, 3)"
_PLAY_ROW = """
songid AS SONGID, mid AS MID, opt AS OPTRATE_TYPE, uid AS UID, cons AS CONSUME_TYPE, dur AS DUR_TIME,
CAST(sid AS VARCHAR) AS SESSION_ID, 'song ' || songid AS SONGNAME, pkg AS PKG_ID, order_id AS ORDER_ID
"""
_PLAY_BODY = """
coalesce(songid, 'null') || chr(9) || mid || chr(9) || opt || chr(9) || coalesce(uid, 'null') || chr(9)
|| cons || chr(9) || dur || chr(9) || sid || chr(9) || 'song ' || songid || chr(9) || pkg || chr(9)
|| order_id
"""

_PLAY_JSON = """
'{"songid":"' || songid || '","mid":"' || mid || '","optrate_type":"' || opt || '"'
|| coalesce(',"uid":"' || uid || '"', '') || ',"consume_type":"' || cons || '","dur_time":"' || dur
|| '","session_id":"' || sid || '","songname":"song ' || songid || '","pkg_id":"' || pkg
|| '","order_id":"' || order_id || '"}'
"""

ORACLE_SQL: dict[str, str] = {
    "log_demux": f"""
        WITH {_PLAYS} SELECT {_PLAY_ROW} FROM plays WHERE {_GOOD_PLAYS}""",
    "log_quarantine": f"""
        WITH {_PLAYS}, bodies AS (SELECT sid, {_PLAY_JSON} AS body FROM plays)
        SELECT 'MINIK_CLIENT_SONG_PLAY_OPERATE_REQ' AS table_name,
               CASE sid // 10 % 4 WHEN 0 THEN substr(body, 1, 20) WHEN 1 THEN body || ' junk'
                    WHEN 2 THEN body || body ELSE chr(9) END AS body
        FROM bodies WHERE sid % 10 = 3""",
    "log_demux_text": f"""
        WITH {_PLAYS}, routed AS (
          SELECT 'OTHER_' || opt AS table_name, '{{"x":' || dur || '}}' AS value
          FROM plays WHERE sid % 10 = 0
          UNION ALL
          SELECT 'MINIK_CLIENT_SONG_PLAY_OPERATE_REQ', {_PLAY_BODY} FROM plays WHERE {_GOOD_PLAYS})
        SELECT table_name, value FROM routed""",
    "log_scan": f"WITH {_PLAYS} SELECT {_PLAY_ROW} FROM plays WHERE {_GOOD_PLAYS}",
    "partition_store": f"WITH {_PLAYS} SELECT dt AS data_dt, {_PLAY_ROW} FROM plays",
    "catalog_store": f"WITH {_PLAYS} SELECT dt AS data_dt, {_PLAY_ROW} FROM plays",
    "table_overwrite": f"WITH {_DIM} SELECT * FROM dim",
    "song_dim": f"WITH {_DIM} SELECT * FROM dim",
    "json_singers": f"""
        WITH {_PART}, s AS (SELECT {_SINGERS} FROM p)
        SELECT SINGER1 AS name1, SINGER1ID AS id1, SINGER2 AS name2, SINGER2ID AS id2,
               count(*) AS n_songs FROM s GROUP BY ALL""",
    "time_normalise": f"WITH {_PART} SELECT nbr AS NBR, {_POST_TIME} AS POST_TIME FROM p",
    "song_features": f"WITH {_FEATURES} SELECT * FROM ftur",
    "song_features_first_load": f"WITH {_FEATURES} SELECT * FROM ftur",
    "song_heat_rank": _SONG_INDEX + _ranked("src", "NBR, NAME", None),
    "song_heat_top": _SONG_INDEX + _ranked("src", "NBR, NAME", 30),
    "singer_heat_rank": _SINGER_INDEX + _ranked("src", "SINGER1ID, SINGER1", None),
    "singer_heat_top": _SINGER_INDEX + _ranked("src", "SINGER1ID, SINGER1", 30),
    "ledger": f"WITH {_LINES}, {_LEDGER} SELECT * FROM ledger",
    "active_users": f"WITH {_USERS} SELECT * EXCLUDE (dt) FROM act WHERE dt = '{DAY}'",
    "active_7d": f"""
        WITH {_USERS}, once AS (
          SELECT UID FROM act WHERE dt BETWEEN '{NEAR}' AND '{DAY}' GROUP BY UID HAVING count(*) = 1)
        SELECT UID,
               CASE REG_CHNL WHEN '1' THEN '微信' WHEN '2' THEN '支付宝' WHEN '3' THEN 'QQ'
                    WHEN '4' THEN 'APP' ELSE '未知' END AS REG_CHNL,
               REF_UID, CASE GDR WHEN '1' THEN '男' WHEN '2' THEN '女' ELSE '不明' END AS GDR,
               BIRTHDAY, MSISDN, REG_DT, LEVEL
        FROM act JOIN once USING (UID) WHERE dt = '{DAY}'""",
    "address_repair": f"WITH {_ADDRESS} SELECT * FROM addr",
    "machine_dim": f"WITH {_MACHINES} SELECT * FROM dimension",
    "machine_positions": f"""
        WITH {_POSITIONS} SELECT CAST(mid AS INTEGER) AS MID, x AS X, y AS Y,
        CAST(cnt AS INTEGER) AS CNT FROM best""",
    "machine_location": f"WITH {_LOCATIONS} SELECT * FROM snapshot",
    "carried_forward": f"""
        WITH {_POSITIONS}
        SELECT CAST(mid AS INTEGER) AS MID, x AS X, y AS Y, CAST(cnt AS INTEGER) AS CNT FROM best
        UNION ALL
        SELECT CAST(s_suppkey AS INTEGER), '10.5', '20.5', 1 FROM supplier
        WHERE s_suppkey NOT IN (SELECT mid FROM best)""",
    "machine_stat": f"WITH {_STAT} SELECT * FROM stat",
    "merchant_share": f"""
        WITH {_STAT}
        SELECT AGE_ID AS ADMIN_ID, PAY_TYPE, CAST(sum(REV_ORDR_CNT) AS BIGINT) AS REV_ORDR_CNT,
               CAST(sum(REF_ORDR_CNT) AS BIGINT) AS REF_ORDR_CNT,
               CAST(sum(TOT_REV) AS DOUBLE) AS TOT_REV, CAST(sum(TOT_REF) AS DOUBLE) AS TOT_REF,
               {_share("INV_RATE", "TOT_INV_REV")}, {_share("AGE_RATE", "TOT_AGE_REV")},
               {_share("COM_RATE", "TOT_COM_REV")}, {_share("PAR_RATE", "TOT_PAR_REV")}
        FROM stat GROUP BY AGE_ID, PAY_TYPE""",
    "region_totals": f"""
        WITH {_STAT}
        SELECT PRVC, CTY, count(MID) AS MAC_CNT, CAST(sum(TOT_REV) AS DECIMAL(38,4)) AS MAC_REV,
               CAST(sum(TOT_REF) AS DECIMAL(38,4)) AS MAC_REF,
               CAST(sum(REV_ORDR_CNT) AS BIGINT) AS MAC_REV_ORDR_CNT,
               CAST(sum(REF_ORDR_CNT) AS BIGINT) AS MAC_REF_ORDR_CNT,
               CAST(sum(CNSM_USR_CNT) AS BIGINT) AS MAC_CNSM_USR_CNT,
               CAST(sum(REF_USR_CNT) AS BIGINT) AS MAC_REF_USR_CNT
        FROM stat GROUP BY PRVC, CTY""",
    "stream_pv": _stream("count(*) AS pv", "mid", "k <> 99", _MINUTE, 5),
    "stream_uv": _stream("count(DISTINCT uid) AS uv", "mid", "k <> 99", _MINUTE, 5),
    "stream_hot_songs": _stream("count(*) AS times", "songname", "true", _MINUTE, 20, _TOP_SONGS),
    "stream_uv_wide": _stream(
        "count(DISTINCT uid) AS uv", "mid", "k <> 99", _WIDE, _HALF_HOUR
    ),
    "stream_hot_songs_wide": _stream(
        "count(*) AS times", "songname", "true", _WIDE, _HALF_HOUR, _TOP_SONGS
    ),
    "stream_late": f"""
        WITH {_ARRIVALS}
        SELECT mid, count(*) AS pv, count(DISTINCT uid) AS uv, CAST(shown AS INTEGER) AS shown
        FROM arrived WHERE mid IS NOT NULL GROUP BY mid, shown""",
    "stream_songs_arrival": f"""
        WITH {_ARRIVALS}, found AS (
          SELECT songname, count(*) AS times, CAST(shown AS INTEGER) AS shown
          FROM arrived GROUP BY songname, shown)
        SELECT *, row_number() OVER (PARTITION BY shown ORDER BY times DESC, songname) AS rank
        FROM found QUALIFY rank <= 30""",
    "stream_catch_up": _stream("count(*) AS pv", "mid", "k <> 99", _WIDE, _HALF_HOUR),
    "stream_resume": _stream("count(*) AS pv", "mid", "k <> 99", _WIDE, _HALF_HOUR),
    "stream_last_window": _stream(
        "count(*) AS pv", "mid", "k <> 99", _WIDE, _HALF_HOUR,
        "SELECT mid, pv FROM found WHERE window_start = (SELECT max(window_start) FROM found)",
    ),
}
