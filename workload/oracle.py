"""The registered queries in SQL, over the same whole tables."""

from workload import tables
from workload.tables import AREAS, AS_OF, CATEGORY_RULES, SINCE


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _values(rows) -> str:
    def cell(v):
        return _text(v) if isinstance(v, str) else str(v)

    return ", ".join("(" + ", ".join(cell(v) for v in row) + ")" for row in rows)


# Derived inputs

USERS = """users AS (SELECT c_custkey AS id, CAST(1 + c_custkey % 3 AS VARCHAR) AS gender,
  1 + c_nationkey % 7 AS job, 1 + c_custkey % 3 AS marriage, 1 + c_custkey * 7 % 4 AS politicalface,
  strftime(DATE '1950-01-01' + CAST(c_custkey * 37 % 25000 AS INTEGER), '%Y-%m-%d') AS birthday
  FROM customer)"""
PAY_ORDERS = """pay_orders AS (SELECT o_orderkey AS ordersn, o_custkey AS memberid,
  CAST(epoch(o_orderdate) AS BIGINT) AS finishtime,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'alipay' WHEN '2-HIGH' THEN 'wxpay'
    WHEN '3-MEDIUM' THEN 'chinapay' WHEN '4-NOT SPECIFIED' THEN 'kjtpay' ELSE 'cod' END AS paymentcode,
  o_orderdate AS created_at, o_orderdate + to_days(CAST(o_orderkey % 60 AS INTEGER)) AS updated_at
  FROM orders)"""
STORED = """stored AS (SELECT c_custkey AS userId, CASE c_custkey % 4 WHEN 0 THEN '8,67'
  WHEN 1 THEN '25,999' WHEN 2 THEN '999' END AS tagsId
  FROM customer WHERE c_mktsegment <> 'MACHINERY')"""
RULES = "rules(id, pid, rule) AS (VALUES " + _values(
    (tag, parent, rule) for parent, rules in CATEGORY_RULES.items() for tag, rule in rules) + ")"
NUMBER_RANGES = """number_ranges AS (SELECT id, pid, TRY_CAST(split_part(rule, '-', 1) AS BIGINT) AS lo,
  TRY_CAST(split_part(rule, '-', 2) AS BIGINT) AS hi FROM rules)"""
DATE_RANGES = """date_ranges AS (SELECT id, pid, TRY_CAST(try_strptime(split_part(rule, '-', 1), '%Y%m%d') AS DATE) AS lo,
  TRY_CAST(try_strptime(split_part(rule, '-', 2), '%Y%m%d') AS DATE) AS hi FROM rules WHERE pid = 14)"""
DERIVED_RULES = """derived_rules AS (SELECT p_partkey AS id, p_partkey // 8 AS pid,
  CASE WHEN p_partkey % 11 = 0 THEN 'x' || (p_partkey % 97)
  ELSE (p_partkey % 97) || '-' || (p_partkey % 97 + 1 + p_partkey % 13) END AS rule FROM part)"""
DERIVED_SOURCES = """derived_sources AS (SELECT p_partkey AS id, 'inType=parquet##esNodes=node' || (p_partkey % 5)
  || '##esIndex=table_' || p_partkey || '##esType=_doc##selectFields=id,f' || p_partkey AS rule FROM part)"""
DAYS = f"""days AS (SELECT memberid, date_diff('day', CAST(to_timestamp(max(finishtime)) AT TIME ZONE 'UTC' AS DATE),
  DATE '{AS_OF}') AS days FROM pay_orders GROUP BY memberid)"""
COUNTS = """counts AS (SELECT memberid, paymentcode, count(memberid) AS paymentcode_cnt
  FROM pay_orders GROUP BY memberid, paymentcode)"""
RANKED = """ranked AS (SELECT *, row_number() OVER (PARTITION BY memberid
  ORDER BY paymentcode_cnt DESC, paymentcode) AS rn FROM counts)"""

_agents = "[" + ", ".join(_text(a) for a in tables.AGENTS) + "]"
LINES = f"""lines AS (SELECT CASE WHEN event_id % 97 = 0 THEN 'malformed ' || event_id ELSE
  '10.' || (user_id % 4) || '.' || (user_id // 256 % 256) || '.' || (user_id % 256) || ' - - ['
  || strftime(ts, '%d/%b/%Y:%H:%M:%S') || ' +0800] "'
  || CASE WHEN event_type IN ('view', 'click') THEN 'GET' ELSE 'POST' END
  || ' /p/' || event_type || '/' || (event_id % 50) || ' HTTP/1.1" '
  || CASE WHEN event_type = 'error' THEN '500' ELSE '200' END || ' ' || event_id
  || ' "-" "' || ({_agents})[event_id % {len(tables.AGENTS)} + 1] || '" "-"' END AS value FROM events)"""
# Written out here and not taken from the code under test, so that a wrong pattern there shows.
_pattern = (r'([0-9]+\.[0-9]+\.[0-9]+\.[0-9]+) - - \[([^\]\x01]+)\] "([A-Z]+) ([^\s\x01]*) ([^\s"\x01]+)" '
            r'([0-9]+) ([0-9]+) "([^"\x01]*)" "([^"\x01]+)" "([^"\x01]+)"')
# At most nine groups can be named here, so the tenth field has a pattern of its own.
_nine = _pattern[:_pattern.rindex("(")] + '[^"\\x01]+"'
PARSED = f"""parsed AS (SELECT value, {", ".join(
    f"regexp_extract(value, {_text(_nine)}, {i + 1}) AS {name}" for i, name in enumerate(
        ("ip", "datetime", "request", "url", "protocol", "code", "sendbytes", "referrer", "useragent")))},
  regexp_extract(value, '" "([^"]+)"$', 1) AS proxyaddr,
  strftime(try_strptime(split_part(regexp_extract(value, {_text(_nine)}, 2), ' ', 1), '%d/%b/%Y:%H:%M:%S'),
    '%Y-%m-%d %H:%M:%S') AS access_time
  FROM lines WHERE regexp_matches(value, {_text(_pattern)}))"""


def _address(ip: str) -> int:
    number = 0
    for octet in ip.split("."):
        number = number * 256 + int(octet)
    return number


AREA_ROWS = "areas(lo, hi, area) AS (VALUES " + _values(
    (_address(first), _address(last), area) for first, last, area in AREAS) + ")"
ZONES = """areas AS (SELECT lo, lo + 2 AS hi, 'zone-' || owner AS area FROM (
  SELECT address - address % 4 AS lo, min(c_custkey) AS owner FROM (SELECT c_custkey,
    167772160 + c_custkey % 4 * 65536 + c_custkey // 256 % 256 * 256 + c_custkey % 256 AS address FROM customer)
  GROUP BY 1))"""
MIXED = """areas AS (SELECT DISTINCT address - address % n AS lo, address - address % n + n - 1 AS hi,
  'area-' || (address - address % n) AS area FROM (SELECT
    167772160 + c_custkey % 4 * 65536 + c_custkey // 256 % 256 * 256 + c_custkey % 256 AS address,
    CASE c_custkey % 4 WHEN 3 THEN 65536 WHEN 2 THEN 256 ELSE 1 END AS n FROM customer))"""
NESTED = """areas AS (SELECT DISTINCT address - address % n AS lo, address - address % n + n - 1 AS hi,
  'area-' || n || '-' || (address - address % n) AS area FROM (SELECT
    167772160 + c_custkey % 4 * 65536 + c_custkey // 256 % 256 * 256 + c_custkey % 256 AS address,
    CASE WHEN c_custkey % 5 = 0 THEN 1 WHEN c_custkey % 5 = 1 THEN 256
      WHEN c_custkey % 5 = 2 AND c_custkey % 4 < 3 THEN 65536 ELSE 16777216 END AS n FROM customer))"""
NUMBERED = """numbered AS (SELECT *, CAST(split_part(ip, '.', 1) AS BIGINT) * 16777216
  + CAST(split_part(ip, '.', 2) AS BIGINT) * 65536 + CAST(split_part(ip, '.', 3) AS BIGINT) * 256
  + CAST(split_part(ip, '.', 4) AS BIGINT) AS number FROM parsed)"""


def _case(column: str, rules) -> str:
    branches = " ".join(f"WHEN regexp_matches({column}, {_text(p)}) THEN {_text(v)}" for p, v in rules)
    return f"CASE {branches} ELSE 'Other' END"


def _agent_columns(column: str, rules=None) -> str:
    rules = rules or {"os": tables.AGENT_RULES.os, "device": tables.AGENT_RULES.device, "browser": tables.AGENT_RULES.browser}
    return ", ".join(f"{_case(column, own)} AS {name}" for name, own in rules.items())


# Fixed values, written out here as well: the default rules by the plain product tokens they look for.
SHIPPED_AGENTS = {
    "os": [("Windows Phone", "Windows Phone"), ("Windows", "Windows"), ("iPhone|iPad|iPod", "iOS"), ("Android", "Android"),
           ("CrOS", "Chrome OS"), ("Mac OS X|Macintosh", "Mac OS X"), ("Ubuntu", "Ubuntu"), ("NetBSD", "NetBSD"),
           ("FreeBSD", "FreeBSD"), ("OpenBSD", "OpenBSD"), ("Linux", "Linux")],
    "device": [("[Bb]ot[/; )]|[Ss]pider|[Cc]rawler", "Spider"), ("iPhone", "iPhone"), ("iPad", "iPad"), ("iPod", "iPod"),
               ("Macintosh", "Mac"), ("HUAWEI|Huawei", "Huawei"), ("Xiaomi|Redmi", "Xiaomi"),
               ("SAMSUNG|SM-[A-Z0-9]+", "Samsung"), ("Android", "Generic Android")],
    "browser": [("MicroMessenger", "WeChat"), ("Edge/|Edg/|EdgA/|EdgiOS/", "Edge"), ("OPR/|Opera", "Opera"),
                ("UCBrowser", "UC Browser"), ("FxiOS/|Firefox/", "Firefox"), ("CriOS/", "Chrome Mobile iOS"),
                ("Chromium/", "Chromium"), ("Android.*Chrome/", "Chrome Mobile"), ("Chrome/", "Chrome"),
                ("MSIE |Trident/", "IE"), ("(iPhone|iPad|iPod).*Safari/", "Mobile Safari"), ("Android.*Safari/", "Android"),
                ("Safari/", "Safari"), ("curl/", "curl")],
}


ACCESS = f"""SELECT m.ip, pv, uv, coalesce(a.area, 'unknown') AS area, TRY_CAST(code AS INTEGER) AS code,
  {_agent_columns("useragent")}, access_time AS datetime
  FROM (SELECT ip, count(ip) AS pv, 1 AS uv, first(code ORDER BY access_time, code, useragent) AS code,
    first(useragent ORDER BY access_time, code, useragent) AS useragent, min(access_time) AS access_time,
    first(number) AS number FROM numbered GROUP BY ip) m
  LEFT JOIN areas a ON m.number BETWEEN a.lo AND a.hi"""

_flags = ", ".join(
    f"'{name}': CASE WHEN event_type = '{kind}' THEN 1 ELSE 0 END" for name, kind in tables.FLAG_OF_TYPE.items())
RECORDS = f"""records AS (SELECT CAST(to_json({{'user_id': CAST(user_id AS VARCHAR),
  'visit_time': strftime(ts, '%Y-%m-%d %H:%M:%S'), 'minimum_price': event_id,
  'area': {{'province': 'P' || (user_id % 7), 'city': 'C' || (user_id % 31)}},
  'user_behavior': {{{_flags}}}}}) AS VARCHAR) AS value FROM events)"""


def _json(path: str, name: str) -> str:
    return f"json_extract_string(value, '$.{path}') AS {name}"


# Fixed values, written out here as well: the fields of an event.
TOP_FIELDS = ("phone_num", "system_id", "user_name", "user_id", "visit_time", "goods_type", "minimum_price")
FLAGS = ("is_browse", "is_order", "is_buy", "is_back_order", "is_received")
NESTED_FIELDS = {
    "area": ("province", "city", "sp"),
    "user_behavior": FLAGS,
    "goods_detail": ("goods_name", "browse_page", "browse_time", "to_page", "to_time", "page_keywords"),
}
_leaves = [_json(name, name) for name in TOP_FIELDS]
_leaves += [_json(f"{outer}.{inner}", inner) for outer, names in NESTED_FIELDS.items() for inner in names]
FLAT = f"flat AS (SELECT {', '.join(_leaves)} FROM records)"
_counts = ", ".join(f"count(CASE WHEN TRY_CAST({f} AS INTEGER) = 1 THEN user_id END) AS {f}_cnt" for f in FLAGS)
BEHAVIOUR = f"SELECT user_id, {_counts} FROM flat GROUP BY user_id"


_object = f"""to_json({{'phone_num': '07' || (user_id % 1000), 'system_id': 'till-' || (event_id % 9),
  'user_name': 'name ' || (user_id % 501), 'user_id': CAST(user_id AS VARCHAR),
  'visit_time': strftime(ts, '%Y-%m-%d %H:%M:%S'), 'goods_type': 'kind ' || (event_id % 13), 'minimum_price': event_id,
  'area': {{'province': 'P' || (user_id % 7), 'city': 'C' || (user_id % 31), 'sp': 'S' || (user_id % 4)}},
  'user_behavior': {{{_flags}}},
  'goods_detail': {{'goods_name': 'goods ' || (event_id % 211),
    'browse_page': 'https://shop.test/p?x=1&y=' || (event_id % 37),
    'browse_time': strftime(ts, '%Y-%m-%d %H:%M:%S'), 'to_page': 'https://shop.test/q/' || (user_id % 19),
    'to_time': strftime(ts, '%Y-%m-%d %H:%M:%S'), 'page_keywords': 'word ' || (event_id % 5)}}}})"""
FULL_RECORDS = f"""records AS (SELECT CASE WHEN event_id % 89 = 0 THEN left(CAST({_object} AS VARCHAR), 25)
  ELSE CAST({_object} AS VARCHAR) END AS value FROM events)"""


def _list(tokens) -> str:
    return "[" + ", ".join(_text(t) for t in tokens) + "]"


AGENT_TEXTS = f"""agent_texts AS (SELECT event_id, 'Mozilla/5.0 (' || ({_list(tables.OS_TOKENS)})[event_id % {
    len(tables.OS_TOKENS)} + 1] || '; ' || ({_list(tables.DEVICE_TOKENS)})[event_id // 12 % {
    len(tables.DEVICE_TOKENS)} + 1] || ') ' || ({_list(tables.BROWSER_TOKENS)})[event_id // 108 % {
    len(tables.BROWSER_TOKENS)} + 1] AS useragent FROM events)"""


MODEL_TEXTS = """model_texts AS (SELECT event_id, 'Mozilla/5.0 (Linux; Android 10; '
  || CASE WHEN event_id % 2 = 0 THEN 'Model-' ELSE 'Type-' END || (event_id % 3001) || ') Mobile Safari/537.36' AS useragent
  FROM events)"""
PART_RULES = """part_rules AS (SELECT p_partkey * 7919 % 10007 * 1000000 + p_partkey AS rank,
  p_brand || ' ' || p_partkey AS value, unnest(CASE WHEN p_partkey % 7 = 0 THEN ['Model-' || p_partkey || ')',
    'Model-' || p_partkey || ';'] WHEN p_partkey % 11 = 0 THEN ['Model-' || p_partkey, 'Type-' || p_partkey]
    ELSE ['Model-' || p_partkey] END) AS literal FROM part)"""


def _silhouette(rows: str, name: str) -> str:
    """Members and silhouette (squared distances) of clusters `c` over rows (vec_id, c, v)."""
    return f"""WITH points AS ({rows}),
cells AS (SELECT vec_id, c, unnest(range(len(v))) AS dim, unnest(v) AS x FROM points),
norms AS (SELECT vec_id, c, sum(x * x) AS norm FROM cells GROUP BY vec_id, c),
sizes AS (SELECT c, count(*) AS n, sum(norm) AS norms FROM norms GROUP BY c),
sums AS (SELECT c, dim, sum(x) AS y FROM cells GROUP BY c, dim),
dots AS (SELECT p.vec_id, s.c, sum(p.x * s.y) AS dot FROM cells p JOIN sums s USING (dim) GROUP BY p.vec_id, s.c),
means AS (SELECT d.vec_id, d.c AS other, p.c AS own, z.n, p.norm + z.norms / z.n - 2 * d.dot / z.n AS m
  FROM dots d JOIN norms p USING (vec_id) JOIN sizes z ON z.c = d.c),
ab AS (SELECT vec_id, max(n) FILTER (other = own) AS n,
  max(m) FILTER (other = own) AS a, min(m) FILTER (other <> own) AS b FROM means GROUP BY vec_id),
scores AS (SELECT vec_id, CASE WHEN n = 1 THEN 0 ELSE (b - a * n / (n - 1)) / greatest(b, a * n / (n - 1)) END AS s FROM ab)
SELECT {name}, count(*) AS members, (SELECT round(avg(s), 6) FROM scores) AS silhouette FROM points GROUP BY c"""


def _lloyd(rounds: int) -> list[str]:
    """Three centres from the first vectors, moved `rounds` times; then each vector's cluster."""
    return ["""vectors AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)""",
            """start AS (SELECT CAST(row_number() OVER (ORDER BY vec_id) AS INTEGER) - 1 AS c, v FROM vectors
  ORDER BY vec_id LIMIT 3)""",
            *(step for i in range(rounds) for step in (
                f"""near{i} AS (SELECT vec_id, v, c FROM (SELECT p.vec_id, p.v, s.c, row_number() OVER (PARTITION BY p.vec_id
  ORDER BY list_sum(list_transform(list_zip(p.v, s.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), s.c) AS rn
  FROM vectors p CROSS JOIN {f'moved{i - 1}' if i else 'start'} s) WHERE rn = 1)""",
                f"""moved{i} AS (SELECT c, list(x ORDER BY dim) AS v FROM (SELECT c, dim, avg(x) AS x FROM (
  SELECT c, unnest(range(len(v))) AS dim, unnest(v) AS x FROM near{i}) GROUP BY c, dim) GROUP BY c
  UNION ALL SELECT c, v FROM {f'moved{i - 1}' if i else 'start'} WHERE c NOT IN (SELECT c FROM near{i}))""")),
            f"""near AS (SELECT vec_id, v, c FROM (SELECT p.vec_id, p.v, s.c, row_number() OVER (PARTITION BY p.vec_id
  ORDER BY list_sum(list_transform(list_zip(p.v, s.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), s.c) AS rn
  FROM vectors p CROSS JOIN moved{rounds - 1} s) WHERE rn = 1)"""]


PARITY = """SELECT vec_id, label % 2 AS c, list_transform(embedding, lambda x: CAST(x AS DOUBLE) + label % 2 * 10) AS v
  FROM embeddings"""


# Tag jobs

def _equal(name: str, source: str, key: str, field: str, parent: int, how: str) -> str:
    return f"""{name} AS (SELECT s.{key} AS userId, CAST(r.id AS VARCHAR) AS tagsId FROM {source} s
  {how} JOIN (SELECT * FROM rules WHERE pid = {parent}) r ON CAST(s.{field} AS VARCHAR) = r.rule)"""


def _collapsed(name: str, source: str) -> str:
    return f"""{name} AS (SELECT userId, string_agg(DISTINCT tagsId, ',' ORDER BY tagsId) AS tagsId
  FROM {source} GROUP BY userId)"""


AGE_NEW = """age_new AS (SELECT u.id AS userId, CAST(r.id AS VARCHAR) AS tagsId FROM users u
  JOIN date_ranges r ON CAST(u.birthday AS DATE) BETWEEN r.lo AND r.hi)"""
CYCLE_NEW = """cycle_new AS (SELECT d.memberid AS userId, CAST(r.id AS VARCHAR) AS tagsId FROM days d
  LEFT JOIN (SELECT * FROM number_ranges WHERE pid = 23) r ON d.days BETWEEN r.lo AND r.hi)"""


def _favourite(rank: int) -> str:
    return f"favourite AS (SELECT memberid, paymentcode FROM ranked WHERE rn = {rank})"


def _sorted(expression: str) -> str:
    return f"nullif(array_to_string(list_sort(list_distinct({expression})), ','), '')"


def _category(parent: int) -> str:
    return "[" + ", ".join(f"'{tag}'" for tag, _ in CATEGORY_RULES[parent]) + "]"


def _merged(new: str, old: str, parent: int | None, drop_stale: bool = False) -> str:
    old_list = f"string_split({old}, ',')"
    if parent is None:
        others = old_list
    else:
        others = f"list_filter({old_list}, lambda x: NOT list_contains({_category(parent)}, x))"
    unmatched = _sorted(others) if drop_stale else old
    return (f"CASE WHEN {new} IS NULL THEN {unmatched} WHEN {old} IS NULL THEN {new} "
            f"ELSE {_sorted(f'list_concat(string_split({new}, chr(44)), {others})')} END")


def _merge(source: str, parent: int | None, drop_stale: bool = False) -> str:
    merged = _merged("n.tagsId", "o.tagsId", parent, drop_stale)
    return f"SELECT n.userId, {merged} AS tagsId FROM {source} n LEFT JOIN stored o ON n.userId = o.userId"


def _with(*parts: str) -> str:
    *ctes, select = parts
    return "WITH " + ",\n".join(ctes) + "\n" + select


GENDER = _equal("new", "users", "id", "gender", 4, "INNER")
UPSERTED = """SELECT userId, tagsId FROM new UNION ALL
SELECT userId, tagsId FROM stored WHERE userId NOT IN (SELECT userId FROM new)"""


def _full_run() -> str:
    """Seven merges and upserts in turn, each a pair of table expressions."""
    ctes = [USERS, PAY_ORDERS, STORED, RULES, NUMBER_RANGES, DATE_RANGES, DAYS, COUNTS, RANKED, _favourite(1),
            AGE_NEW, CYCLE_NEW]
    steps = [
        (4, _equal("n4", "users", "id", "gender", 4, "INNER"), "n4"),
        (7, _equal("n7", "users", "id", "job", 7, "LEFT"), "n7"),
        (14, None, "age_new"),
        (23, None, "cycle_new"),
        (30, _equal("n30", "favourite", "memberid", "paymentcode", 30, "LEFT"), "n30"),
        (62, _equal("n62", "users", "id", "politicalface", 62, "LEFT"), "n62"),
        (66, _equal("n66", "users", "id", "marriage", 66, "LEFT"), "n66"),
    ]
    before = "stored"
    for parent, cte, source in steps:
        if cte:
            ctes.append(cte)
        ctes.append(_collapsed(f"c{parent}", source))
        merged = _merged("n.tagsId", "o.tagsId", parent)
        ctes.append(f"""m{parent} AS (SELECT n.userId, {merged} AS tagsId FROM c{parent} n
  LEFT JOIN {before} o ON n.userId = o.userId)""")
        ctes.append(f"""s{parent} AS (SELECT * FROM m{parent} WHERE tagsId IS NOT NULL UNION ALL
  SELECT userId, tagsId FROM {before} WHERE userId NOT IN
    (SELECT userId FROM m{parent} WHERE tagsId IS NOT NULL))""")
        before = f"s{parent}"
    return _with(*ctes, f"SELECT userId, tagsId FROM {before}")


CYCLE_INPUT = [PAY_ORDERS, STORED, RULES, NUMBER_RANGES, DAYS, CYCLE_NEW]
_scaled = """SELECT vec_id, dim, round(CASE WHEN top = bottom THEN 0.5
  ELSE (v - bottom) / (top - bottom) END, 9) AS value
FROM (SELECT *, min(v) OVER (PARTITION BY dim) AS bottom, max(v) OVER (PARTITION BY dim) AS top
  FROM (SELECT vec_id, CAST(unnest(range(len(embedding))) AS INTEGER) AS dim,
    CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings))"""

ORACLE = {
    "scan_pruned": "SELECT o_orderkey, o_custkey FROM orders",
    "tag_upsert": _with(USERS, RULES, STORED, GENDER, UPSERTED),
    "tag_store_write": _with(USERS, RULES, STORED, GENDER, UPSERTED),
    "tag_upsert_buckets": _with(USERS, RULES, STORED, GENDER, UPSERTED),
    "rule_children": _with(DERIVED_RULES, "SELECT pid AS parent, id, rule FROM derived_rules"),
    "rule_decode": _with(DERIVED_SOURCES, "SELECT id, " + ", ".join(
        f"regexp_extract(rule, '(?:^|##){key}=([^#]*)', 1) AS {key}" for key in
        ("inType", "esNodes", "esIndex", "esType", "selectFields")) + " FROM derived_sources"),
    "rule_ranges": _with(DERIVED_RULES, """SELECT id, TRY_CAST(split_part(rule, '-', 1) AS BIGINT) AS lo,
  TRY_CAST(nullif(split_part(rule, '-', 2), '') AS BIGINT) AS hi FROM derived_rules"""),
    "category_ids": _with(DERIVED_RULES, """SELECT pid, string_agg(CAST(id AS VARCHAR), ','
  ORDER BY CAST(id AS VARCHAR)) AS ids FROM derived_rules GROUP BY pid"""),
    "filter_gt": _with(USERS, "SELECT * FROM users WHERE id > 4"),
    "incremental_filter": _with(PAY_ORDERS, f"""SELECT ordersn, memberid FROM pay_orders
  WHERE created_at >= TIMESTAMP '{SINCE}' OR updated_at >= TIMESTAMP '{SINCE}'"""),
    "tag_equal_inner": _with(USERS, RULES, GENDER, "SELECT * FROM new"),
    "tag_equal_left": _with(USERS, RULES, _equal("new", "users", "id", "job", 7, "LEFT"), "SELECT * FROM new"),
    "tag_range_inner": _with(USERS, RULES, DATE_RANGES, AGE_NEW, "SELECT * FROM age_new"),
    "tag_range_left": _with(PAY_ORDERS, RULES, NUMBER_RANGES, DAYS, CYCLE_NEW, "SELECT * FROM cycle_new"),
    "tag_range_shuffled": _with(PAY_ORDERS, RULES, NUMBER_RANGES, f"""SELECT p.ordersn AS userId,
  CAST(r.id AS VARCHAR) AS tagsId FROM (SELECT ordersn, date_diff('day', CAST(to_timestamp(finishtime)
    AT TIME ZONE 'UTC' AS DATE), DATE '{AS_OF}') AS days FROM pay_orders) p
  LEFT JOIN (SELECT * FROM number_ranges WHERE pid = 23) r ON p.days BETWEEN r.lo AND r.hi"""),
    "entity_mapping": """SELECT o_custkey AS userId, l_orderkey, l_linenumber, l_partkey
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "recency_days": _with(PAY_ORDERS, DAYS, "SELECT * FROM days"),
    "category_counts": _with(PAY_ORDERS, COUNTS, "SELECT * FROM counts"),
    "ranked_categories": _with(PAY_ORDERS, COUNTS, RANKED, "SELECT * FROM ranked"),
    "payway_top1": _with(PAY_ORDERS, COUNTS, RANKED, _favourite(1), "SELECT * FROM favourite"),
    "payway_second": _with(PAY_ORDERS, COUNTS, RANKED, _favourite(2), "SELECT * FROM favourite"),
    "recency_and_favourite": _with(PAY_ORDERS, DAYS, COUNTS, RANKED, _favourite(1),
                                   "SELECT memberid, days, paymentcode FROM days JOIN favourite USING (memberid)"),
    "keyed_reduce": """SELECT l_suppkey, CAST(sum(q) AS BIGINT) AS reduced, greatest(max(q), 0) AS folded,
  CAST(sum(q) AS BIGINT) AS total, count(q) AS items
  FROM (SELECT l_suppkey, CAST(l_quantity AS BIGINT) AS q FROM lineitem) GROUP BY l_suppkey""",
    "preview_topn": _with(PAY_ORDERS, """SELECT ordersn, memberid, finishtime FROM pay_orders
  ORDER BY finishtime DESC, ordersn LIMIT 20"""),
    "fn_strings": _with(USERS, """SELECT id, replace(birthday, '-', '') AS compact,
  split_part(birthday, '-', 1) AS year, split_part(birthday, '-', 2) AS month, CAST(NULL AS VARCHAR) AS absent
  FROM users"""),
    "fn_tag_sets": _with(STORED.replace(" WHERE c_mktsegment <> 'MACHINERY'", ""), f"""SELECT userId,
  {_sorted("list_filter(string_split(tagsId, ','), lambda x: NOT list_contains(['25', '67'], x))")} AS "without",
  {_sorted("list_concat(['25', '67'], string_split(tagsId, ','))")} AS united
  FROM stored WHERE tagsId IS NOT NULL UNION ALL
  SELECT userId, NULL, NULL FROM stored WHERE tagsId IS NULL"""),
    "user_agent_default_rules": _with(
        AGENT_TEXTS, f"SELECT *, {_agent_columns('useragent', SHIPPED_AGENTS)} FROM agent_texts"),
    "user_agent_many_rules": _with(MODEL_TEXTS, PART_RULES, """spelled AS (SELECT DISTINCT useragent FROM model_texts),
  found AS (SELECT useragent, arg_min(value, rank) AS device FROM spelled JOIN part_rules
    ON contains(useragent, literal) GROUP BY useragent)""", """SELECT event_id, useragent, 'Android' AS os,
  coalesce(device, 'Other') AS device, 'Android' AS browser FROM model_texts LEFT JOIN found USING (useragent)"""),
    "event_json_full": _with(FULL_RECORDS, FLAT.replace("FROM records", "FROM records WHERE json_valid(value)"),
                             "SELECT * FROM flat"),
    "event_json_rejects": _with(FULL_RECORDS, "SELECT value FROM records WHERE NOT json_valid(value)"),
    "kmeans_assign": "SELECT vec_id, min(vec_id) OVER (PARTITION BY label % 2) AS cluster FROM embeddings",
    "kmeans_quality": _silhouette(PARITY, "min(vec_id) AS cluster"),
    "stream_from_position": """SELECT event_id % 6 AS partition, event_id // 6 AS "offset", event_type FROM events
  WHERE event_id // 6 >= CASE event_id % 6 WHEN 0 THEN 100 WHEN 1 THEN 0 WHEN 2 THEN 1000000000000 WHEN 3 THEN 7 ELSE 50 END""",
    "kmeans_rounds_assign": _with(*_lloyd(4), "SELECT vec_id, c AS cluster FROM near"),
    "kmeans_rounds_quality": _with(*_lloyd(4), _silhouette("SELECT * FROM near", "c AS cluster")
                                   .removeprefix("WITH ").split("\nSELECT ")[0],
                                   """SELECT p.c AS cluster, count(*) AS members, round(avg(s), 6) AS silhouette,
  (SELECT round(avg(s), 6) FROM scores) AS overall FROM points p JOIN scores USING (vec_id) GROUP BY p.c"""),
    "silhouette_given": _silhouette("SELECT vec_id, label AS c, CAST(embedding AS DOUBLE[]) AS v FROM embeddings",
                                    "any_value(c) AS label"),
    "tag_spend_band": _with(RULES, NUMBER_RANGES, STORED, """new AS (SELECT memberid AS userId,
  CAST(r.id AS VARCHAR) AS tagsId FROM (SELECT o_custkey AS memberid, sum(CAST(floor(o_totalprice) AS BIGINT)) AS amount
    FROM orders GROUP BY o_custkey) LEFT JOIN (SELECT * FROM number_ranges WHERE pid = 80) r
    ON amount BETWEEN r.lo AND r.hi)""", _merge("new", 80)),
    "tag_merge": _with(*CYCLE_INPUT, _collapsed("new", "cycle_new"), _merge("new", 23)),
    "tag_merge_drop_stale": _with(USERS, RULES, STORED, _equal("new", "users", "id", "job", 7, "LEFT"),
                                  _merge("new", 7, drop_stale=True)),
    "tag_merge_union": _with(USERS, RULES, STORED, GENDER, _merge("new", None)),
    "access_log_parse": _with(LINES, PARSED, "SELECT * EXCLUDE (value) FROM parsed"),
    "access_log_rejects": _with(LINES, f"""SELECT value FROM lines
  WHERE NOT regexp_matches(value, {_text(_pattern)})"""),
    "ip_area_join": _with(LINES, PARSED, NUMBERED, AREA_ROWS, """SELECT ip, sendbytes,
  coalesce(area, 'unknown') AS area FROM numbered LEFT JOIN areas ON number BETWEEN lo AND hi"""),
    "ip_area_join_shuffled": _with(LINES, PARSED, NUMBERED, ZONES, """SELECT ip, sendbytes,
  coalesce(area, 'unknown') AS area FROM numbered LEFT JOIN areas ON number BETWEEN lo AND hi"""),
    "ip_area_mixed_widths": _with(LINES, PARSED, NUMBERED, MIXED, """SELECT ip, sendbytes,
  coalesce(area, 'unknown') AS area FROM numbered LEFT JOIN areas ON number BETWEEN lo AND hi"""),
    "ip_area_mixed_widths_shuffled": _with(LINES, PARSED, NUMBERED, MIXED, """SELECT ip, sendbytes,
  coalesce(area, 'unknown') AS area FROM numbered LEFT JOIN areas ON number BETWEEN lo AND hi"""),
    "ip_area_nested": _with(LINES, PARSED, NUMBERED, NESTED, """placed AS (SELECT number,
  arg_min(area, hi - lo) AS area FROM (SELECT DISTINCT number FROM numbered) JOIN areas ON number BETWEEN lo AND hi
  GROUP BY number)""", """SELECT ip, sendbytes, coalesce(area, 'unknown') AS area
  FROM numbered LEFT JOIN placed USING (number)"""),
    "user_agent_classify": _with(LINES, PARSED, f"SELECT sendbytes, useragent, {_agent_columns('useragent')} FROM parsed"),
    "access_metrics": _with(LINES, PARSED, NUMBERED, AREA_ROWS, ACCESS),
    "event_json_parse": _with(RECORDS, FLAT, "SELECT * FROM flat"),
    "event_json_tuple": _with(RECORDS, FLAT, f"SELECT {', '.join(TOP_FIELDS)} FROM flat"),
    "event_json_paths": _with(RECORDS, FLAT, "SELECT user_id, province, is_buy, goods_name FROM flat"),
    "behaviour_counts": _with(RECORDS, FLAT, BEHAVIOUR),
    "stream_append_sink": _with(LINES, "SELECT value FROM lines"),
    "stream_append_once": _with(LINES, "SELECT value FROM lines"),
    "stream_foreach_batch": _with(RECORDS, FLAT, f"counted AS ({BEHAVIOUR})",
                                  "SELECT *, 'a' AS sink FROM counted UNION ALL SELECT *, 'b' AS sink FROM counted"),
    "stream_watermark_counts": _with(RECORDS, FLAT, f"""timed AS (SELECT *,
  strptime(visit_time, '%Y-%m-%d %H:%M:%S') AS visited FROM flat)""",
                                     f"""SELECT strftime(date_trunc('day', visited), '%Y-%m-%d %H:%M:%S') AS window_start,
  {_counts} FROM timed GROUP BY date_trunc('day', visited)
  HAVING date_trunc('day', visited) + INTERVAL 1 DAY
    <= (SELECT max(visited) FROM timed) - INTERVAL 10 MINUTE"""),
    "minmax_scale": _scaled,
    "string_index": """SELECT event_id, event_type, CAST(place AS DOUBLE) AS event_index FROM events JOIN (
  SELECT event_type, row_number() OVER (ORDER BY count(*) DESC, event_type) - 1 AS place
  FROM events GROUP BY event_type) USING (event_type)""",
    "string_index_distributed": """SELECT l_orderkey, l_linenumber, CAST(place AS DOUBLE) AS order_index FROM lineitem JOIN (
  SELECT l_orderkey, row_number() OVER (ORDER BY count(*) DESC, CAST(l_orderkey AS VARCHAR)) - 1 AS place
  FROM lineitem GROUP BY l_orderkey) USING (l_orderkey)""",
    "index_to_string": "SELECT event_id, event_type AS restored FROM events",
    "model_score": """SELECT o_orderkey, CAST(CAST(o_totalprice * 0.5 + 3.25 AS FLOAT) AS DOUBLE) AS prediction
  FROM orders""",
    "pipeline_score": "SELECT o_orderkey, o_totalprice * 0.5::DOUBLE + 3.25::DOUBLE AS prediction FROM orders",
    "tag_gender": _with(USERS, RULES, STORED, GENDER, _merge("new", 4)),
    "tag_job": _with(USERS, RULES, STORED, _equal("new", "users", "id", "job", 7, "LEFT"), _merge("new", 7)),
    "tag_age_band": _with(USERS, RULES, STORED, DATE_RANGES, AGE_NEW, _collapsed("new", "age_new"),
                          _merge("new", 14)),
    "tag_consume_cycle": _with(*CYCLE_INPUT, _collapsed("new", "cycle_new"), _merge("new", 23)),
    "tag_payway": _with(PAY_ORDERS, RULES, STORED, COUNTS, RANKED, _favourite(1),
                        _equal("new", "favourite", "memberid", "paymentcode", 30, "LEFT"), _merge("new", 30)),
    "tag_payway_second": _with(PAY_ORDERS, RULES, STORED, COUNTS, RANKED, _favourite(2),
                               _equal("new", "favourite", "memberid", "paymentcode", 30, "LEFT"),
                               _merge("new", 30)),
    "tag_political": _with(USERS, RULES, STORED, _equal("new", "users", "id", "politicalface", 62, "LEFT"),
                           _merge("new", 62)),
    "tag_marriage": _with(USERS, RULES, STORED, _equal("new", "users", "id", "marriage", 66, "LEFT"),
                          _merge("new", 66)),
    "tag_full_run": _full_run(),
    # The orders as they are after all changes, read whole.
    "tag_incremental_run": _with(PAY_ORDERS.replace("pay_orders AS", "all_orders AS"), f"""pay_orders AS (
  SELECT memberid, CASE WHEN changed THEN finishtime + 40 * 86400 ELSE finishtime END AS finishtime,
    CASE WHEN changed THEN 'other' ELSE paymentcode END AS paymentcode
  FROM (SELECT *, created_at < TIMESTAMP '{SINCE}' AS known, known AND ordersn % 7 = 1 AS changed FROM all_orders)
  WHERE NOT (known AND ordersn % 7 = 0))""", RULES, NUMBER_RANGES, DAYS, COUNTS, RANKED, _favourite(1), CYCLE_NEW,
                                 _equal("paid", "favourite", "memberid", "paymentcode", 30, "LEFT"),
                                 "both_new AS (SELECT * FROM cycle_new UNION ALL SELECT * FROM paid)",
                                 _collapsed("new", "both_new"), """SELECT userId, new.tagsId FROM (
  SELECT DISTINCT memberid AS userId FROM all_orders) LEFT JOIN new USING (userId)"""),
    "tag_overlapping_ranges": _with(RULES, NUMBER_RANGES, """SELECT o_custkey AS userId,
  coalesce(string_agg(DISTINCT CAST(id AS VARCHAR), ',' ORDER BY CAST(id AS VARCHAR)), '') AS tagsId,
  count(DISTINCT o_orderkey) AS orders, count(id) AS matches
  FROM orders LEFT JOIN (SELECT * FROM number_ranges WHERE pid IN (80, 90)) r ON floor(o_totalprice) BETWEEN r.lo AND r.hi
  GROUP BY o_custkey"""),
}
# The same rows computed another way.
for twin, original in {
    "tag_equal_shuffled": "tag_equal_left",
    "tag_merge_unbounded": "tag_merge",
    "user_agent_dictionary": "user_agent_classify",
    "stream_access_metrics": "access_metrics",
    "stream_behaviour_counts": "behaviour_counts",
    "tag_full_run_in_turn": "tag_full_run",
    "tag_store_full_run": "tag_full_run",
    "stream_access_update": "access_metrics",
    "stream_behaviour_update": "behaviour_counts",
    "stream_restart_new_checkpoint": "behaviour_counts",
}.items():
    ORACLE[twin] = ORACLE[original]
