"""The registered queries once more, as SQL for DuckDB over the same tables."""

from __future__ import annotations

from pricetrail.functions.columns import PRODUCT_URL_PREFIX
from pricetrail.plans.views import LAUNCH_VIEWS
from workload.frames import AS_OF, SNAPSHOT_DAY, USAGE_AS_OF
from workload.queries import FIVE_SETS, ITEM_ID, LEDGER_SINCE, MONTH_SINCE, SINCE

ORACLE: dict[str, str] = {}

# --- inputs -------------------------------------------------------------------------------

RARITY = """CASE p_size % 4 WHEN 0 THEN 'mythic' WHEN 1 THEN 'rare'
            WHEN 2 THEN 'uncommon' ELSE 'common' END"""
PRICES_M = """prices_m AS (
    SELECT user_id AS id, CAST(ts AS DATE) AS pull_date, CAST(max(value) AS DECIMAL(10,2)) AS usd
    FROM events GROUP BY 1, 2)"""
ITEMS_M = """items_m AS (
    SELECT p_partkey AS id, p_partkey AS tcgplayer_id, p_name AS name, p_brand AS set_name,
           p_type AS set_type, DATE '2010-01-01' + p_size * 100 AS released_at FROM part)"""


def line_prices(name: str, where: str = "TRUE", raised: str = "") -> str:
    return f"""{name} AS (
    SELECT l_partkey AS id, CAST(l_shipdate AS DATE) AS pull_date,
           CAST(min(l_extendedprice) AS DECIMAL(8,2)){raised} AS usd,
           CAST(min(CASE WHEN l_discount > 0.03 THEN CAST(l_extendedprice AS DECIMAL(10,2))
                    * (1 - CAST(l_discount AS DECIMAL(4,2))) END) AS DECIMAL(8,2)) AS usd_foil
    FROM lineitem WHERE {where} GROUP BY 1, 2)"""


PRICES_L = line_prices("prices_l")
ITEMS_L = f"""items_l AS (
    SELECT CASE WHEN p_partkey % 11 = 5 THEN -p_partkey ELSE p_partkey END AS id, p_partkey AS tcgplayer_id, p_name AS name, p_brand AS set_name,
           p_type AS set_type, DATE '1998-01-01' + p_size * 20 AS released_at, {RARITY} AS rarity
    FROM part)"""


def double(*names: str) -> str:
    return ", ".join(f'CAST("{name}" AS DOUBLE) AS "{name}"' for name in names)


def quoted(values) -> str:
    return ", ".join(f"'{value}'" for value in values)


# --- movers -------------------------------------------------------------------------------

SLICE = f"""{PRICES_M}, {ITEMS_M}, slice AS (
    SELECT p.id, i.tcgplayer_id, i.name, i.set_name, i.set_type, i.released_at, p.usd, p.pull_date
    FROM prices_m p JOIN items_m i ON p.id = i.id
    WHERE p.usd <> 0 AND i.released_at >= DATE '{AS_OF}' - INTERVAL 10 YEAR
      AND p.pull_date IN (DATE '{AS_OF}', DATE '{AS_OF}' - 7, DATE '{AS_OF}' - 14, DATE '{AS_OF}' - 28))"""

ORACLE["lookback_slice"] = f"""WITH {SLICE}
SELECT id, tcgplayer_id, name, set_name, set_type, released_at, {double("usd")}, pull_date FROM slice"""


def _ratio(weeks: int) -> str:
    return f"""CASE WHEN today <> 0 AND w{weeks} <> 0
        THEN round_even(CAST(today AS DOUBLE) / CAST(w{weeks} AS DOUBLE) * 10000, 0) / 10000
        END AS "{weeks}wk_diff\""""


MOVERS = f"""{SLICE}, wide AS (
    SELECT id, tcgplayer_id, name, set_name, set_type, released_at,
           max(usd) FILTER (pull_date = DATE '{AS_OF}') AS today,
           max(usd) FILTER (pull_date = DATE '{AS_OF}' - 7) AS w1,
           max(usd) FILTER (pull_date = DATE '{AS_OF}' - 14) AS w2,
           max(usd) FILTER (pull_date = DATE '{AS_OF}' - 28) AS w4
    FROM slice GROUP BY ALL),
movers AS (
    SELECT id, '{PRODUCT_URL_PREFIX}' || tcgplayer_id AS tcgplayer_id, name, set_name, set_type, released_at,
           CAST(today AS DOUBLE) AS today_price, DATE '{AS_OF}' AS today_price_date,
           CAST(w1 AS DOUBLE) AS "1wk_ago_price", CAST(w2 AS DOUBLE) AS "2wk_ago_price",
           CAST(w4 AS DOUBLE) AS "4wk_ago_price", {_ratio(1)}, {_ratio(2)}, {_ratio(4)}
    FROM wide WHERE today >= 1)"""

ORACLE["price_movers"] = f"""WITH {MOVERS} SELECT * FROM movers ORDER BY "4wk_diff" DESC NULLS LAST, id"""
ORACLE["csv_publish"] = ORACLE["price_movers"]
ORACLE["csv_slice"] = f"""WITH {SLICE}
SELECT CAST(id AS VARCHAR) AS id, tcgplayer_id, name, set_name, set_type, released_at,
       {double("usd")}, pull_date FROM slice"""
ORACLE["daily_run"] = ORACLE["movers_from_slice"] = f"""WITH {MOVERS}
SELECT * REPLACE (CAST(id AS VARCHAR) AS id) FROM movers"""


def _top(k: int, by: str) -> str:
    sides = " UNION ALL ".join(
        f"""SELECT * FROM (SELECT *, '{direction}' AS direction FROM movers
        WHERE "{by}" IS NOT NULL ORDER BY "{by}" {order}, id LIMIT {k})"""
        for direction, order in (("up", "DESC"), ("down", "ASC"))
    )
    return f"WITH {MOVERS} {sides}"


ORACLE["top_movers"] = _top(10, "4wk_diff")
ORACLE["top_movers_week"] = _top(3, "1wk_diff")

# --- launch curves ------------------------------------------------------------------------


def _curve(price="usd", days=(1, 300), rare=False, five=False) -> str:
    keys = "set_name, rarity" if five else "set_name"
    where = ["set_type = 'PROMO'", f"date_diff BETWEEN {days[0]} AND {days[1]}"]
    if rare:
        where.append("rarity IN ('mythic', 'rare')")
    where.append(f"set_name IN ({quoted(FIVE_SETS)})" if five else f"released_at >= DATE '{SINCE}'")
    return f"""WITH {PRICES_L}, {ITEMS_L}, offsets AS (
    SELECT i.*, p.usd, p.usd_foil, p.pull_date - i.released_at AS date_diff
    FROM items_l i LEFT JOIN prices_l p ON i.id = p.id)
SELECT CAST(date_diff AS INTEGER) AS date_diff,
       CAST(sum({price}) AS DOUBLE) / nullif(count({price}), 0) AS avg_usd, {keys}
FROM offsets WHERE {" AND ".join(where)} GROUP BY date_diff, {keys} ORDER BY date_diff DESC"""


ORACLE["launch_after"] = _curve()
ORACLE["launch_after_foil"] = _curve("usd_foil")
ORACLE["launch_after_rare"] = _curve(rare=True)
ORACLE["launch_after_foil_rare"] = _curve("usd_foil", rare=True)
ORACLE["launch_variable"] = _curve(five=True)
ORACLE["launch_before"] = _curve(days=(-45, 0))
ORACLE["launch_before_foil"] = _curve("usd_foil", days=(-45, 0))

ITEMS_MONTH = f"""items_month AS (
    SELECT CAST(p_partkey AS VARCHAR) AS id, p_partkey AS tcgplayer_id, p_name AS name, p_brand AS set_name,
           p_type AS set_type, DATE '2023-10-01' + p_size * 2 AS released_at, {RARITY} AS rarity FROM part)"""
PRICES_MONTH = f"""{PRICES_M}, prices_month AS (
    SELECT CAST(id AS VARCHAR) AS id, usd, CAST(usd * 2 AS DECIMAL(10,2)) AS usd_foil, pull_date FROM prices_m)"""


def _month_curve(view: str) -> str:
    price = "usd_foil" if "foil" in view else "usd"
    days = "BETWEEN -45 AND 0" if "before" in view else "BETWEEN 1 AND 300"
    five = view.endswith("variable")
    where = f"set_name IN ({quoted(FIVE_SETS)})" if five else f"released_at >= DATE '{MONTH_SINCE}'"
    if view.endswith("rare_mythic"):
        where += " AND rarity IN ('mythic', 'rare')"
    return f"""SELECT '{view}' AS view, CAST(date_diff AS INTEGER) AS date_diff,
    CAST(sum({price}) AS DOUBLE) / nullif(count({price}), 0) AS avg_usd, set_name,
    {"rarity" if five else "CAST(NULL AS VARCHAR)"} AS rarity
FROM offsets WHERE set_type = 'PROMO' AND date_diff {days} AND {where}
GROUP BY date_diff, set_name{", rarity" if five else ""}"""


ORACLE["launch_from_state"] = f"""WITH {PRICES_MONTH}, {ITEMS_MONTH}, offsets AS (
    SELECT i.*, p.usd, p.usd_foil, p.pull_date - i.released_at AS date_diff
    FROM items_month i JOIN prices_month p ON i.id = p.id)
""" + "\nUNION ALL ".join(_month_curve(view) for view in LAUNCH_VIEWS)

# --- usage and ledger ---------------------------------------------------------------------

USAGE = """log AS (
    SELECT ts AS start_time, event_type AS warehouse_name, CAST(value AS DECIMAL(12,4)) AS credits_used
    FROM events)"""
CREDITS = "CAST(sum(credits_used) AS DOUBLE)"
COST = "CAST(round(sum(credits_used) * 2, 2) AS DOUBLE)"

ORACLE["usage_recent"] = f"""WITH {USAGE}
SELECT start_time, warehouse_name, {double("credits_used")} FROM log ORDER BY start_time DESC"""
ORACLE["cost_by_day_resource"] = f"""WITH {USAGE}
SELECT CAST(start_time AS DATE) AS day, warehouse_name, {CREDITS} AS credits_used, {COST} AS cost
FROM log GROUP BY 1, 2 ORDER BY day DESC, credits_used DESC"""
ORACLE["cost_by_resource"] = f"""WITH {USAGE}
SELECT warehouse_name, {CREDITS} AS credits_used, {COST} AS cost
FROM log GROUP BY 1 ORDER BY credits_used DESC"""
ORACLE["cost_daily"] = f"""WITH {USAGE}
SELECT CAST(start_time AS DATE) AS day, {COST} AS daily_usd, {CREDITS} AS daily_credits
FROM log GROUP BY 1 ORDER BY day DESC"""
ORACLE["cost_rollup_30d"] = f"""WITH {USAGE}, dated AS (
    SELECT CAST(start_time AS DATE) AS d, credits_used FROM log
    WHERE start_time >= DATE '{USAGE_AS_OF}' - 30)
SELECT CASE WHEN d IS NULL THEN 'All' ELSE strftime(d, '%Y-%m-%d') END AS day,
       {COST} AS daily_usd, {CREDITS} AS daily_credits
FROM dated GROUP BY ROLLUP (d) ORDER BY day DESC"""

LEDGER = """ledger AS (
    SELECT CASE WHEN o_orderstatus = 'O' THEN 'prices' ELSE 'items' END AS table_name,
           'part-' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS file_name,
           round(CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) / 100000, 2) AS file_mb,
           o_orderdate AS load_time
    FROM orders)"""
ORACLE["ledger_history"] = f"WITH {LEDGER} SELECT * FROM ledger ORDER BY load_time DESC, table_name, file_name DESC"
ORACLE["ledger_recent"] = f"""WITH {LEDGER} SELECT * FROM ledger
WHERE table_name = 'prices' AND load_time >= DATE '{LEDGER_SINCE}' - 7 ORDER BY file_name DESC"""

# --- lookups ------------------------------------------------------------------------------

ORACLE["item_history"] = f"""WITH {PRICES_L}, {ITEMS_L}
SELECT i.name, CAST(p.usd AS DOUBLE) AS usd, CAST(p.usd_foil AS DOUBLE) AS usd_foil, p.pull_date
FROM prices_l p LEFT JOIN items_l i ON p.id = i.id WHERE p.id = {ITEM_ID} ORDER BY p.pull_date"""
ORACLE["table_fn_history"] = ORACLE["layout_by_id"] = ORACLE["item_history"]


def _mean(price: str) -> str:
    """Mean to two digits, half up, in whole cents."""
    return f"""((2 * CAST(sum({price}) * 100 AS BIGINT) + count({price}))
        // nullif(2 * count({price}), 0)) / 100.0"""


def _search(where: str, inputs: str = f"{PRICES_L}, {ITEMS_L}", prices: str = "prices_l", items: str = "items_l") -> str:
    return f"""WITH {inputs}
SELECT i.name, i.set_name, i.id, '{PRODUCT_URL_PREFIX}' || i.tcgplayer_id AS tcgplayer_url,
       count(p.id) AS price_records_count,
       CAST({_mean("p.usd")} AS DOUBLE) AS avg_price,
       CAST(min(p.usd) AS DOUBLE) AS min_price, CAST(max(p.usd) AS DOUBLE) AS max_price,
       CAST({_mean("p.usd_foil")} AS DOUBLE) AS avg_foil_price,
       CAST(min(p.usd_foil) AS DOUBLE) AS min_foil_price, CAST(max(p.usd_foil) AS DOUBLE) AS max_foil_price
FROM {items} i LEFT JOIN {prices} p ON i.id = p.id
WHERE {where} GROUP BY i.name, i.set_name, i.id, i.tcgplayer_id
ORDER BY i.name, i.set_name, i.id LIMIT 10000"""


ORACLE["search_items"] = _search("lower(i.name) LIKE '%red%' AND lower(i.set_name) LIKE '%brand#1%'")
ORACLE["search_indexed"] = ORACLE["search_items"]
ORACLE["search_items_any"] = _search("TRUE")
ORACLE["search_from_state"] = _search("TRUE", f"{PRICES_MONTH}, {ITEMS_MONTH}", "prices_month", "items_month")
ORACLE["table_fn_search"] = ORACLE["search_items"]
ORACLE["lookup_join"] = f"""WITH {PRICES_L}
SELECT p.id, p.pull_date, CAST(p.usd AS DOUBLE) AS usd, CAST(p.usd_foil AS DOUBLE) AS usd_foil, g.game
FROM prices_l p LEFT JOIN (
    SELECT p_partkey AS id, p_size % 16 + 1 AS game FROM part WHERE p_type = 'PROMO') g ON p.id = g.id"""

# --- snapshot flattening and loading ------------------------------------------------------

USD_TEXT = """CASE p_size % 10 WHEN 0 THEN NULL WHEN 1 THEN 'n/a'
              ELSE CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS VARCHAR) END"""
FOIL = "CASE WHEN p_size % 10 NOT IN (0, 3) THEN CAST(CAST(p_retailprice AS DECIMAL(10,2)) + p_size AS DECIMAL(10,2)) END"
USD = "CASE WHEN p_size % 10 NOT IN (0, 1) THEN CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS DOUBLE) END"

ORACLE["json_flatten"] = f"""
SELECT CAST(p_partkey AS VARCHAR) AS id, {USD_TEXT} AS usd, CAST({FOIL} AS VARCHAR) AS usd_foil FROM part"""
ORACLE["json_array_lines"] = ORACLE["json_flatten"]
ORACLE["daily_prices"] = f"""
SELECT CAST(p_partkey AS VARCHAR) AS id, {USD} AS usd, CAST({FOIL} AS DOUBLE) AS usd_foil,
       '{SNAPSHOT_DAY}' AS pull_date
FROM part WHERE p_size % 10 <> 0"""
ORACLE["reject_split"] = f"""
SELECT CAST(p_partkey AS VARCHAR) AS id, {USD} AS usd, CAST({FOIL} AS DOUBLE) AS usd_foil,
       DATE '{SNAPSHOT_DAY}' AS pull_date,
       CASE WHEN p_size % 10 = 1 THEN 'usd' ELSE '' END AS bad_columns
FROM part"""


def _items(day: str) -> str:
    return f"""SELECT CAST(p_partkey AS VARCHAR) AS id, 'o' || p_partkey AS oracle_id,
       CAST(p_partkey * 2 AS DOUBLE) AS mtgo_id,
       CAST(CASE WHEN p_size % 5 <> 0 THEN p_partkey * 2 + 1 END AS DOUBLE) AS mtgo_foil_id,
       CAST(p_partkey AS DOUBLE) AS tcgplayer_id, CAST(p_partkey + 7 AS DOUBLE) AS cardmarket_id,
       p_name AS name, 'en' AS lang, DATE '2010-01-01' + p_size * 100 AS released_at,
       p_brand AS set_name, lower(p_brand) AS set_abbr, p_type AS set_type, {RARITY} AS rarity,
       DATE '{day}' AS pull_date FROM part"""


ORACLE["static_fields"] = f"""
SELECT * EXCLUDE (set_abbr) REPLACE (CAST(released_at AS VARCHAR) AS released_at,
       CAST(pull_date AS VARCHAR) AS pull_date), set_abbr AS "set"
FROM ({_items(str(SNAPSHOT_DAY))})"""
_ITEM_COLUMNS = """id oracle_id mtgo_id mtgo_foil_id tcgplayer_id cardmarket_id name lang released_at
set_name set_abbr set_type rarity pull_date""".split()
_GIVEN = ("id", "tcgplayer_id", "released_at", "set_abbr", "set_type", "pull_date")
_NUMBERS = ("mtgo_id", "mtgo_foil_id", "cardmarket_id")
ORACLE["conform_by_name"] = (
    "SELECT "
    + ", ".join(
        c if c in _GIVEN else f"CAST(NULL AS {'DOUBLE' if c in _NUMBERS else 'VARCHAR'}) AS {c}"
        for c in _ITEM_COLUMNS
    )
    + f" FROM ({_items(str(SNAPSHOT_DAY))})"
)
ORACLE["job_counts"] = """
SELECT 'prices' AS dataset, count(*) AS row_count FROM part WHERE p_size % 10 <> 0
UNION ALL SELECT 'items', count(*) FROM part"""

# The wide table's columns, written out here independently of the code under test.
_FORMATS = """standard future historic timeless gladiator pioneer explorer modern legacy pauper vintage penny
commander oathbreaker standardbrawl brawl alchemy paupercommander duel oldschool premodern predh""".split()
_FLAGS = """highres_image foil nonfoil reserved oversized promo digital full_art textless reprint variation booster
story_spotlight game_changer""".split()
_LISTS = "colors color_identity produced_mana keywords games finishes artist_ids frame_effects promo_types".split()
_TEXTS = """layout mana_cost type_line oracle_text power toughness image_status artist illustration_id border_color
frame security_stamp watermark card_back_id""".split()
_SIZES = "small normal large png art_crop border_crop".split()
_FACE = "name mana_cost type_line oracle_text power toughness".split()
_WIDE = {
    "id": "CAST(p_partkey AS VARCHAR)",
    "oracle_id": "'o' || p_partkey",
    "multiverse_ids": "p_partkey || ',' || (p_partkey + 1)",
    "name": "p_name",
    "lang": "'en'",
    "object": "'card'",
    "set_code": "lower(p_brand)",
    "set_name": "p_brand",
    "set_id": "'s' || lower(p_brand)",
    "set_type": "p_type",
    "collector_number": "CAST(p_partkey AS VARCHAR)",
    "released_at": "DATE '2010-01-01' + p_size * 100",
    "cmc": "CAST(p_size / 2 AS VARCHAR)",
    "rarity": RARITY,
    "tcgplayer_id": "CAST(p_partkey AS INTEGER)",
    "mtgo_id": "CAST(p_partkey * 2 AS INTEGER)",
    "mtgo_foil_id": "CAST(CASE WHEN p_size % 5 <> 0 THEN p_partkey * 2 + 1 END AS INTEGER)",
    "cardmarket_id": "CAST(p_partkey + 7 AS INTEGER)",
    "edhrec_rank": "p_size",
    "preview_previewed_at": "DATE '2009-12-24'",
    "preview_source_uri": "'uri ' || p_partkey",
    "preview_source": "'source ' || p_partkey",
    "purchase_uris_tcgplayer": "'buy/' || p_partkey",
    "pull_date": f"DATE '{SNAPSHOT_DAY}'",
    **{name: f"'{name} ' || p_partkey" for name in _TEXTS},
    **{name: f"CASE p_size % 3 WHEN 0 THEN '' WHEN 1 THEN '{name}1' ELSE '{name}1,{name}2' END" for name in _LISTS},
    **{name: f"p_size % {n} = 0" for n, name in enumerate(_FLAGS, start=2)},
    **{
        f"legalities_{name}": f"CASE WHEN p_size % {n} = 0 THEN 'legal' ELSE 'not_legal' END"
        for n, name in enumerate(_FORMATS, start=2)
    },
    **{f"image_uris_{name}": f"'img/{name} ' || p_partkey" for name in _SIZES},
    **{f"card_faces_front_{field}": f"CASE WHEN p_size % 3 >= 1 THEN 'front {field} ' || p_partkey END" for field in _FACE},
    **{f"card_faces_back_{field}": f"CASE WHEN p_size % 3 = 2 THEN 'back {field} ' || p_partkey END" for field in _FACE},
}
ORACLE["flatten_wide"] = "SELECT " + ", ".join(f"{value} AS {name}" for name, value in _WIDE.items()) + " FROM part"

_LATER = _WIDE | {"edhrec_rank": "p_size + 3000000000"}
_EARLIER = _WIDE | {"pull_date": f"DATE '{SNAPSHOT_DAY}' - 7", "edhrec_rank": "CAST(p_size AS BIGINT)"}
ORACLE["load_wide"] = f"""
SELECT {", ".join(f"{value} AS {name}" for name, value in _LATER.items())}, 'note ' || p_partkey AS release_note
FROM part WHERE p_size % 4 <> 1
UNION ALL
SELECT {", ".join(f"{value} AS {name}" for name, value in _EARLIER.items())}, NULL FROM part WHERE p_size % 4 = 1 AND p_type <> 'PROMO'"""

# --- merges -------------------------------------------------------------------------------

ORACLE["merge_insert_only"] = f"""WITH {line_prices("target", "l_linestatus = 'F'")},
{line_prices("source", raised=" + 1")}
SELECT id, pull_date, {double("usd", "usd_foil")} FROM target
UNION ALL
SELECT id, pull_date, {double("usd", "usd_foil")} FROM source s
WHERE NOT EXISTS (SELECT 1 FROM target t WHERE t.id = s.id AND t.pull_date = s.pull_date)"""

ITEM_MERGE = """target AS (
    SELECT p_partkey AS id, p_name AS name, p_brand AS set_name, p_type AS set_type,
           DATE '2024-01-01' AS pull_date FROM part WHERE p_type <> 'PROMO'),
source AS (
    SELECT p_partkey AS id, upper(p_name) AS name, p_brand AS set_name, p_type AS set_type,
           CASE WHEN p_size <> 50 THEN DATE '2023-12-07' + p_size END AS pull_date FROM part)"""
ORACLE["upsert_newer_wins"] = f"""WITH {ITEM_MERGE}
SELECT t.id, CASE WHEN s.pull_date > t.pull_date THEN s.name ELSE t.name END AS name, t.set_name, t.set_type,
       CASE WHEN s.pull_date > t.pull_date THEN s.pull_date ELSE t.pull_date END AS pull_date
FROM target t LEFT JOIN source s ON t.id = s.id
UNION ALL SELECT * FROM source s WHERE s.id NOT IN (SELECT id FROM target)"""
ORACLE["upsert_outcome"] = f"""WITH {ITEM_MERGE}, counts AS (SELECT
    (SELECT count(*) FROM source s WHERE NOT EXISTS (SELECT 1 FROM target t WHERE t.id = s.id)) AS rows_inserted,
    (SELECT count(*) FROM source s JOIN target t ON t.id = s.id WHERE s.pull_date > t.pull_date) AS rows_updated,
    (SELECT count(*) FROM source s JOIN target t ON t.id = s.id WHERE s.pull_date <= t.pull_date) AS rows_skipped)
SELECT *, rows_inserted + rows_updated AS rows_merged FROM counts"""
ORACLE["latest_snapshot"] = """WITH dated AS (
    SELECT p_partkey AS id, p_name AS name, p_brand AS set_name, p_type AS set_type,
           DATE '2024-01-01' + p_size % 3 * 7 AS pull_date FROM part)
SELECT * FROM dated
WHERE pull_date = (SELECT max(pull_date) FROM dated WHERE pull_date <= DATE '2024-01-12')"""

# --- files and streams --------------------------------------------------------------------

LANDED = f"""{PRICES_M}, landed AS (
    SELECT CAST(id AS VARCHAR) AS id, CAST(usd AS DOUBLE) AS usd, CAST(usd * 2 AS DOUBLE) AS usd_foil, pull_date
    FROM prices_m)"""
ORACLE["partition_roundtrip"] = f"""WITH {LANDED}
SELECT id, usd, usd_foil, strftime(pull_date, '%Y-%m-%d') AS pull_date, strftime(pull_date, '%Y') AS year,
       strftime(pull_date, '%m') AS month, strftime(pull_date, '%d') AS day FROM landed"""
ORACLE["register_partition"] = (
    ORACLE["partition_roundtrip"] + " WHERE pull_date IN (DATE '2024-01-08', DATE '2024-01-09')"
)
ORACLE["load_items"] = """
SELECT turn, CASE turn WHEN 1 THEN n ELSE 0 END AS rows_inserted, CASE turn WHEN 3 THEN n ELSE 0 END AS rows_updated,
       CASE turn WHEN 2 THEN n ELSE 0 END AS rows_skipped, CASE turn WHEN 2 THEN 0 ELSE n END AS rows_merged
FROM (SELECT count(*) AS n FROM part), (VALUES (1), (2), (3)) turns(turn)"""
ORACLE["partition_slice"] = f"WITH {LANDED} SELECT * FROM landed WHERE pull_date = DATE '2024-01-08'"
ORACLE["stream_ingest"] = f"WITH {LANDED} SELECT * FROM landed"
ORACLE["compact_days"] = f"WITH {LANDED} SELECT *, TRUE AS few_files FROM landed"
ORACLE["day_count"] = f"WITH {PRICES_M} SELECT count(*) AS total_count FROM prices_m WHERE pull_date = DATE '2024-01-16'"
ORACLE["partition_missing"] = """
SELECT DISTINCT 'items' AS dataset, CAST(ts AS DATE) AS pull_date FROM events WHERE dayofweek(ts) <> 1"""
ORACLE["copy_new_files"] = f"""WITH {PRICES_M}
SELECT 1 AS turn, 'prices' AS table_name, count(*) AS rows_inserted, 0 AS rows_rejected
FROM prices_m WHERE pull_date < DATE '2024-01-16'
UNION ALL SELECT 2, 'prices', count(*), 0 FROM prices_m WHERE pull_date >= DATE '2024-01-16'
UNION ALL SELECT 3, 'prices', 0, 0"""
ORACLE["stream_then_batch"] = f"""WITH {PRICES_M}
SELECT 1 AS turn, FALSE AS new_files, 0 AS rows_inserted
UNION ALL SELECT 2, TRUE, count(*) FROM prices_m WHERE pull_date >= DATE '2024-01-16'
UNION ALL SELECT 3, FALSE, count(*) FROM prices_m"""
_RECONCILED = f"""WITH {PRICES_M}, days AS (
    SELECT CAST(unnest(generate_series(DATE '2024-01-01', DATE '2024-01-30', INTERVAL 1 DAY)) AS DATE) AS pull_date),
counted AS (
    SELECT d.pull_date, count(id) FILTER (day(d.pull_date) NOT IN (10, 11, 12)) AS landed_rows,
           count(id) FILTER (day(d.pull_date) NOT IN (10, 11, 12)
               AND NOT (day(d.pull_date) = 25 AND id % 2 = 0) AND NOT (day(d.pull_date) = 20 AND id % 2 = 1)) AS curated_rows
    FROM days d LEFT JOIN prices_m p ON p.pull_date = d.pull_date GROUP BY 1),
reconciled AS (
    SELECT *, CASE WHEN landed_rows = 0 THEN 'missing' WHEN day(pull_date) = 20 AND curated_rows < landed_rows THEN 'not loaded'
        WHEN curated_rows < landed_rows THEN 'short' ELSE 'complete' END AS state FROM counted)"""
ORACLE["reconcile_days"] = f"{_RECONCILED} SELECT * FROM reconciled"
ORACLE["missing_ranges"] = f"""{_RECONCILED}, placed AS (
    SELECT pull_date, pull_date - CAST(row_number() OVER (ORDER BY pull_date) AS INTEGER) AS run
    FROM reconciled WHERE state = 'missing')
SELECT min(pull_date) AS first_day, max(pull_date) AS last_day, count(*) AS n_days FROM placed GROUP BY run"""
ORACLE["layout_levels"] = f"""WITH {PRICES_L}
SELECT CAST(id AS VARCHAR) AS id, {double("usd", "usd_foil")}, pull_date, TRUE AS few_runs FROM prices_l"""
ORACLE["replay_rejects"] = f"""WITH {LANDED}
SELECT id, CASE WHEN state = 'loaded' THEN usd END AS usd, usd_foil, pull_date, state
FROM (SELECT *, CASE WHEN CAST(id AS BIGINT) % 3 <> 0 AND day(pull_date) = 25 THEN 'rejected' ELSE 'loaded' END AS state
      FROM landed)"""
ORACLE["load_mixed_types"] = ORACLE["shared_table_load"] = ORACLE["stream_ingest"]
ORACLE["merge_pruned"] = f"""WITH {LANDED}, views AS (
    SELECT DISTINCT CAST(user_id AS VARCHAR) AS id, CAST(ts AS DATE) AS pull_date FROM events WHERE event_type = 'view')
SELECT * FROM landed l
WHERE (pull_date = DATE '2024-01-01' OR pull_date >= DATE '2024-01-16')
  AND NOT EXISTS (SELECT 1 FROM views v WHERE v.id = l.id AND v.pull_date = l.pull_date)"""
ORACLE["partition_files"] = f"""WITH {PRICES_M}
SELECT 'prices' AS dataset, pull_date, count(*) AS row_count, TRUE AS all_read FROM prices_m GROUP BY pull_date
UNION ALL
SELECT 'items', DATE '2024-01-01' + 7 * week, n, TRUE
FROM (SELECT count(*) AS n FROM part), (SELECT unnest(range(5))::INTEGER AS week)"""
ORACLE["file_columns"] = """
SELECT 'part-' || o_orderkey AS file_name,
       round(CAST(o_totalprice * 1000 AS BIGINT) / 1048576.0, 2) AS size_mb FROM orders"""
ORACLE["stream_merge"] = f"""WITH {LANDED}, views AS (
    SELECT CAST(user_id AS VARCHAR) AS id, CAST(ts AS DATE) AS pull_date,
           CAST(max(value) AS DECIMAL(10,2)) AS usd
    FROM events WHERE event_type = 'view' GROUP BY 1, 2)
SELECT id, CAST(usd AS DOUBLE) AS usd, CAST(usd * 2 AS DOUBLE) AS usd_foil, pull_date FROM views
UNION ALL
SELECT * FROM landed l WHERE NOT EXISTS (
    SELECT 1 FROM views v WHERE v.id = l.id AND v.pull_date = l.pull_date)"""
ORACLE["stream_upsert"] = f"""
SELECT * REPLACE (upper(name) AS name) FROM ({_items("2024-01-08")}) WHERE set_type <> 'PROMO'
UNION ALL SELECT * FROM ({_items("2024-01-01")}) WHERE set_type = 'PROMO'"""
