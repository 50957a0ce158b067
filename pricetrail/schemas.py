"""Fixed column sets of the data model."""

from __future__ import annotations

from pyspark.sql import types as T


STRING, DOUBLE, DATE, TIMESTAMP = T.StringType(), T.DoubleType(), T.DateType(), T.TimestampType()
MONEY, WHOLE = T.DecimalType(10, 2), T.DecimalType(10, 0)


def _struct(names, data_type: T.DataType = STRING) -> T.StructType:
    return T.StructType([T.StructField(name, data_type) for name in names])


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, data_type) for name, data_type in columns.items()])


# Landing layer: what the daily flatten job writes, one directory per day.
LANDING_PRICES = _schema(id=STRING, usd=DOUBLE, usd_foil=DOUBLE, pull_date=STRING)
LANDING_ITEMS = _schema(
    id=STRING, oracle_id=STRING, mtgo_id=DOUBLE, mtgo_foil_id=DOUBLE, tcgplayer_id=DOUBLE,
    cardmarket_id=DOUBLE, name=STRING, lang=STRING, released_at=STRING, set_name=STRING,
    set=STRING, set_type=STRING, rarity=STRING, pull_date=STRING,
)
DAY_PARTITIONS = _struct(("year", "month", "day"))

# Curated layer: typed once, partitioned by pull_date (prices) or kept in versions (items).
PRICES = _schema(id=STRING, usd=MONEY, usd_foil=MONEY, pull_date=DATE)
ITEMS = _schema(
    id=STRING, oracle_id=STRING, mtgo_id=WHOLE, mtgo_foil_id=WHOLE, tcgplayer_id=WHOLE,
    cardmarket_id=WHOLE, name=STRING, lang=STRING, released_at=DATE, set_name=STRING,
    set_abbr=STRING, set_type=STRING, rarity=STRING, pull_date=DATE,
)
# The landing column `set` fills the curated column `set_abbr`.
ITEM_RENAMES = {"set": "set_abbr"}

LOOKUP = _schema(id=STRING, game=T.IntegerType())
USAGE = _schema(start_time=TIMESTAMP, warehouse_name=STRING, credits_used=T.DecimalType(18, 9))
LEDGER = _schema(table_name=STRING, file_name=STRING, file_mb=DOUBLE, load_time=TIMESTAMP)
PARTS = _schema(version=T.LongType(), part=STRING, path=STRING, rows=T.LongType(), load=STRING, schema=STRING)
RUN_FILES = _schema(run=STRING, file=STRING, first_id=STRING, last_id=STRING)
JOURNAL = _schema(load=STRING, path=STRING)
GENERATIONS = _schema(generation=T.IntegerType(), pull_date=DATE)

# Maintained aggregates.
_SUMS = {
    "records": T.LongType(), "usd_sum": T.DecimalType(20, 2), "usd_n": T.LongType(),
    "usd_foil_sum": T.DecimalType(20, 2), "usd_foil_n": T.LongType(),
}
ITEM_STATS = _schema(id=STRING, **_SUMS, usd_min=MONEY, usd_max=MONEY, usd_foil_min=MONEY, usd_foil_max=MONEY)
TRAITS = _schema(id=STRING, released_at=DATE, set_name=STRING, set_type=STRING, rarity=STRING)
LAUNCH_STATE = _schema(
    pull_date=DATE, released_at=DATE, set_name=STRING, set_type=STRING, rarity=STRING, **_SUMS
)

# The rows between the price slice and the movers report.
MOVER_SLICE = _schema(
    id=STRING, tcgplayer_id=T.LongType(), name=STRING, set_name=STRING, set_type=STRING,
    released_at=DATE, usd=MONEY, pull_date=DATE,
)

# The play formats, image sizes and face fields of the wide item table.
LEGALITY_FORMATS = (
    "standard", "future", "historic", "timeless", "gladiator", "pioneer", "explorer", "modern",
    "legacy", "pauper", "vintage", "penny", "commander", "oathbreaker", "standardbrawl", "brawl",
    "alchemy", "paupercommander", "duel", "oldschool", "premodern", "predh",
)
IMAGE_SIZES = ("small", "normal", "large", "png", "art_crop", "border_crop")
FACE_FIELDS = ("name", "mana_cost", "type_line", "oracle_text", "power", "toughness")
ITEM_FLAGS = (
    "foil", "nonfoil", "reserved", "oversized", "promo", "digital", "full_art", "textless",
    "reprint", "variation", "booster", "story_spotlight", "game_changer",
)
ITEM_LISTS = (
    "multiverse_ids", "colors", "color_identity", "produced_mana", "keywords", "games",
    "finishes", "artist_ids", "frame_effects", "promo_types",
)
ITEM_NUMBERS = ("tcgplayer_id", "mtgo_id", "mtgo_foil_id", "cardmarket_id", "edhrec_rank")
WIDE_COLUMNS = (
    "id", "oracle_id", "multiverse_ids", "name", "lang", "object", "set_code", "set_name",
    "set_id", "set_type", "collector_number", "released_at", "layout", "mana_cost", "cmc",
    "type_line", "oracle_text", "power", "toughness", "colors", "color_identity",
    "produced_mana", "keywords",
    *(f"legalities_{name}" for name in LEGALITY_FORMATS),
    "games", "finishes", "highres_image", "image_status", "rarity", "artist", "artist_ids",
    "illustration_id", "border_color", "frame", "frame_effects", "security_stamp", "watermark",
    *ITEM_FLAGS,
    "card_back_id", "promo_types", *ITEM_NUMBERS,
    "preview_previewed_at", "preview_source_uri", "preview_source",
    *(f"image_uris_{size}" for size in IMAGE_SIZES),
    "purchase_uris_tcgplayer",
    *(f"card_faces_{side}_{field}" for side in ("front", "back") for field in FACE_FIELDS),
    "pull_date",
)


# Raw snapshot.  Numbers are read as text and cast later, so that one malformed value costs
# one field and not the record.
RAW_SNAPSHOT = T.StructType(
    _struct((
        "id", "oracle_id", "mtgo_id", "mtgo_foil_id", "tcgplayer_id", "cardmarket_id", "name",
        "lang", "released_at", "set_name", "set", "set_type", "rarity",
    )).fields
    + [T.StructField("prices", _struct(("usd", "usd_foil")))]
)

RAW_WIDE = T.StructType(
    RAW_SNAPSHOT.fields
    + _struct((
        "object", "set_id", "collector_number", "layout", "mana_cost", "cmc", "type_line",
        "oracle_text", "power", "toughness", "image_status", "artist", "illustration_id",
        "border_color", "frame", "security_stamp", "watermark", "card_back_id", "edhrec_rank",
    )).fields
    + _struct(ITEM_LISTS, T.ArrayType(STRING)).fields
    + _struct(("highres_image",) + ITEM_FLAGS, T.BooleanType()).fields
    + [
        T.StructField("legalities", _struct(LEGALITY_FORMATS)),
        T.StructField("image_uris", _struct(IMAGE_SIZES)),
        T.StructField("preview", _struct(("previewed_at", "source_uri", "source"))),
        T.StructField("purchase_uris", _struct(("tcgplayer",))),
        T.StructField("card_faces", T.ArrayType(_struct(FACE_FIELDS))),
    ]
)
