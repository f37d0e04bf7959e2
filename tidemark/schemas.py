"""Tables: required columns, keys, types. Extra columns people add are kept."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

_S, _L, _D, _B = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType()
_DATE, _TS = T.DateType(), T.TimestampType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields])


@dataclass(frozen=True)
class Table:
    """``key`` identifies a row; ``dated_by`` names the key column used for partitions."""

    name: str
    schema: T.StructType
    key: tuple[str, ...] = ()
    dated_by: str | None = None


BUYLIST = Table("buylist", _struct(
    ("商品名", _S), ("グレード", _S), ("買取価格", _S), ("在庫", _S),
    ("受付状態", _S), ("画像URL", _S), ("取得日時", _TS)))

RESOLVE_MAP = Table("resolve_map", _struct(
    ("品番", _S), ("名前", _S), ("検索キー", _S), ("product_url", _S),
    ("解決日時", _TS), ("備考", _S)))

MARKET_SNAPSHOT = Table("market_snapshot", _struct(
    ("品番", _S), ("名前", _S), ("最安価格", _S), ("出品枚数", _S),
    ("直近取引価格", _S), ("取得日時", _TS)))

INDEX_HISTORY = Table("index_history", _struct(
    ("date", _DATE), ("index_type", _S), ("value", _D), ("diff", _D),
    ("diff_pct", _D), ("fetched_at", _TS)),
    key=("date", "index_type"), dated_by="date")

#: Additive state of a day's mean: what earlier batches gave, and what the last one gave.
INDEX_STATE = Table("index_state", _struct(
    ("date", _DATE), ("index_type", _S), ("base_total", _L), ("base_points", _L),
    ("last_batch", _L), ("last_total", _L), ("last_points", _L)),
    key=("date", "index_type"), dated_by="date")

#: Group series of the card history, a row per group and day.
GROUP_HISTORY = Table("group_history", _struct(
    ("date", _DATE), ("scope", _S), ("key", _S), ("price", _D), ("trade_count", _L)),
    key=("date", "scope", "key"), dated_by="date")

CARD_HISTORY = Table("card_history", _struct(
    ("date", _DATE), ("card_id", _S), ("card_name", _S), ("hinban", _S),
    ("condition", _S), ("price", _L), ("trade_count", _L),
    ("imputed_suspect", _B), ("fetched_at", _TS)),
    key=("date", "card_id", "condition"), dated_by="date")

CARD_MASTER = Table("card_master", _struct(
    ("card_id", _S), ("card_name", _S), ("hinban", _S), ("url", _S),
    ("last_seen_at", _TS)), key=("card_id",))

WATCHLIST = Table("watchlist", _struct(
    ("品番", _S), ("名前", _S), ("card_id", _S), ("url", _S), ("メモ", _S)),
    key=("品番", "名前"))

CARD_STATUS = Table("card_status", _struct(
    ("品番", _S), ("名前", _S), ("状態", _S), ("傾向", _S), ("買取調整%", _D),
    ("最新価格", _L), ("最新日", _DATE), ("最新が補完", _B),
    ("d1%", _D), ("d3%", _D), ("d7%", _D), ("ma5", _D), ("ma20", _D),
    ("連続日数", _L), ("変動%", _D), ("有効観測日", _L), ("記録日数", _L),
    ("判定根拠", _S), ("直近1週間", _S), ("card_id", _S), ("更新日時", _TS)),
    key=("card_id", "状態"))

TREND = Table("trend", _struct(
    ("date", _DATE), ("scope", _S), ("key", _S), ("label", _S),
    ("d1", _D), ("d3", _D), ("d7", _D), ("ma5", _D), ("ma20", _D),
    ("streak", _L), ("vol20", _D), ("valid_days", _L), ("trend", _S),
    ("suggested_buffer_pct", _D), ("imputation_basis", _S), ("fetched_at", _TS)),
    key=("date", "scope", "key"), dated_by="date")

TABLES = {t.name: t for t in (
    BUYLIST, RESOLVE_MAP, MARKET_SNAPSHOT, INDEX_HISTORY, INDEX_STATE, CARD_HISTORY, GROUP_HISTORY,
    CARD_MASTER, WATCHLIST, CARD_STATUS, TREND)}
