"""The two lookups as SQL table functions over registered views.

A call inlines the body with its arguments, so a literal id reaches the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from pricetrail.functions.columns import PRODUCT_URL_PREFIX
from pricetrail.operators.lookup import MAX_MATCHES


def register_item_prices(
    spark: SparkSession, prices: str, items: str, name: str = "get_card_prices", id_type: str = "STRING"
) -> None:
    """``name(card_id)``: one item's prices by date."""
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(card_id {id_type})
        RETURNS TABLE (name STRING, usd DECIMAL(8,2), usd_foil DECIMAL(8,2), pull_date DATE)
        RETURN
        SELECT /*+ BROADCAST(n) */ n.name, p.usd, p.usd_foil, p.pull_date
        FROM {prices} AS p
        LEFT JOIN (
            SELECT i.id, max(i.name) AS name FROM {items} AS i
            WHERE i.id = {name}.card_id GROUP BY i.id
        ) AS n ON p.id = n.id
        WHERE p.id = {name}.card_id
        ORDER BY p.pull_date NULLS LAST, p.usd NULLS LAST, p.usd_foil NULLS LAST
    """)


def _term(column: str, argument: str) -> str:
    # Spark's LIKE escapes with a backslash; doubling it keeps a backslash in a term literal.
    pattern = rf"concat('%', replace(lower({argument}), r'\', r'\\'), '%')"
    return f"({argument} IS NULL OR {argument} = '' OR lower({column}) LIKE {pattern})"


def register_item_search(
    spark: SparkSession, prices: str, items: str, name: str = "get_card_id", id_type: str = "STRING"
) -> None:
    """``name(card_name, set_search)``: items with price statistics, at most 10,000."""

    def mean(price):
        return f"CAST(round(try_divide(sum({price}), count({price})), 2) AS DECIMAL(10,2))"

    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(card_name STRING, set_search STRING)
        RETURNS TABLE (
            name STRING, set_name STRING, id {id_type}, tcgplayer_url STRING, price_records_count BIGINT,
            avg_price DECIMAL(10,2), min_price DECIMAL(10,2), max_price DECIMAL(10,2),
            avg_foil_price DECIMAL(10,2), min_foil_price DECIMAL(10,2), max_foil_price DECIMAL(10,2))
        RETURN
        SELECT i.name, i.set_name, i.id,
               concat('{PRODUCT_URL_PREFIX}', CAST(TRY_CAST(i.tcgplayer_id AS BIGINT) AS STRING)),
               coalesce(sum(s.records), 0),
               max(s.avg_usd), max(s.min_usd), max(s.max_usd),
               max(s.avg_foil), max(s.min_foil), max(s.max_foil)
        FROM {items} AS i
        LEFT JOIN (
            SELECT id, count(*) AS records,
                   {mean("usd")} AS avg_usd, min(usd) AS min_usd, max(usd) AS max_usd,
                   {mean("usd_foil")} AS avg_foil, min(usd_foil) AS min_foil, max(usd_foil) AS max_foil
            FROM {prices} LEFT SEMI JOIN (
                SELECT w.id AS wanted FROM {items} AS w
                WHERE {_term("w.name", name + ".card_name")} AND {_term("w.set_name", name + ".set_search")})
            ON id = wanted
            GROUP BY id
        ) AS s ON i.id = s.id
        WHERE {_term("i.name", name + ".card_name")} AND {_term("i.set_name", name + ".set_search")}
        GROUP BY i.name, i.set_name, i.id, i.tcgplayer_id
        ORDER BY i.name NULLS LAST, i.set_name NULLS LAST, i.id
        LIMIT {MAX_MATCHES}
    """)
