"""Projection, casting and validation of raw records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.fixed_values import RAW_TRADE_ID, TICK_COLUMNS, TRADE_REQUIRED
from marketlake.functions import epoch_ms_to_ts, is_epoch_ms, to_double
from marketlake.schemas import CORRUPT

REASON = "reject_reason"


def as_declared(df: DataFrame, required: Mapping[str, str], optional: Mapping[str, str]) -> DataFrame:
    """Project onto a declared layout, name to type: values are cast tolerantly, an absent optional
    column is a typed null, an absent required one an error."""
    require_columns(df, tuple(required))
    here = set(df.columns)
    return df.select(
        *[
            (F.col(name).try_cast(kind) if name in here else F.lit(None).cast(kind)).alias(name)
            for name, kind in {**required, **optional}.items()
        ]
    )


def require_columns(df: DataFrame, needed: Sequence[str]) -> DataFrame:
    missing = [c for c in needed if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}; found {df.columns}")
    return df


def computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are evaluated once per row, however often they are used.

    A filter is pushed down through a projection by repeating its expressions, and a
    parsed document or number would be parsed again for each use. It is not pushed
    through a generator, so the columns come out of one that makes one row per row.
    """
    made = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select("*", F.inline(F.array(made)))


def tag_rejects(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Add ``reject_reason``: names of all broken rules, null for a valid row.

    One narrow pass; valid and rejected rows are two filters on the result.
    """
    names = [F.when(broken, F.lit(name)) for name, broken in rules.items()]
    return df.withColumn(REASON, F.nullif(F.concat_ws(",", *names), F.lit("")))


def valid_rows(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.col(REASON).isNull()).drop(REASON)


def rejected_rows(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.col(REASON).isNotNull())


def _absent(c: str) -> Column:
    return F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == "")


def _not_a_number(c: str) -> Column:
    return F.col(c).isNull() | F.isnan(c)


def normalize_ticks(raw: DataFrame) -> DataFrame:
    """Raw text ticks to typed ticks, tagged with ``reject_reason``.

    Adds ``event_ts`` (UTC, zone-free). The id of the trade, ``trade_id`` or ``a`` as the
    published raw layout calls it, becomes a bigint, so that ids order by number; one that is
    there but no number is a reason to reject. Other raw columns are kept.
    """
    require_columns(raw, TICK_COLUMNS)
    if RAW_TRADE_ID in raw.columns and "trade_id" not in raw.columns:
        raw = raw.withColumnRenamed(RAW_TRADE_ID, "trade_id")
    read = computed_once(
        raw,
        _price=to_double("price"),
        _quantity=to_double("quantity"),
        _event_ms=to_double("event_time"),
    )
    rules = {
        "symbol": _absent("symbol"),
        "price": _not_a_number("_price"),
        "quantity": _not_a_number("_quantity"),
        "event_time": ~is_epoch_ms("_event_ms"),
    }
    typed = {"price": F.col("_price"), "quantity": F.col("_quantity")}
    if "trade_id" in raw.columns:
        number = F.col("trade_id").try_cast("bigint")
        rules["trade_id"] = number.isNull() & ~_absent("trade_id")
        typed["trade_id"] = number
    if CORRUPT in raw.columns:
        rules = {"malformed": F.col(CORRUPT).isNotNull(), **rules}
    return (
        tag_rejects(read, rules)
        .withColumns({**typed, "event_ts": epoch_ms_to_ts("_event_ms")})
        .drop("_price", "_quantity", "_event_ms")
    )


def normalize_rates(raw: DataFrame) -> DataFrame:
    """Rates with ``fx_date`` to typed rates with year and month, tagged."""
    require_columns(raw, ("code", "currency", "mid", "fx_date"))
    typed = raw.withColumns(
        {
            "mid": to_double("mid"),
            "year": F.year("fx_date"),
            "month": F.month("fx_date"),
        }
    )
    return tag_rejects(
        typed,
        {
            "fx_date": F.col("fx_date").isNull(),
            "code": F.col("code").isNull(),
            "mid": _not_a_number("mid"),
        },
    )


def parse_trades(df: DataFrame, payload: str = "value") -> DataFrame:
    """Trade JSON text to validated, normalised ticks, tagged.

    Reasons: ``malformed`` (not an object), ``missing_<field>`` for an absent
    required field, ``type_<field>`` for one that is there but not a number. Other
    columns of ``df`` (topic offsets, arrival time) are kept.

    All fields come out of one pass over the text, as text, so that a bad value can be
    told from a missing one; ``json_tuple`` also keeps apart names that differ by case
    only (``e``, ``E``), which a struct schema would mix up.
    """
    text = F.col(payload).cast("string")
    # columns by number: names that differ by case only would be ambiguous
    column = {name: f"_f{i}" for i, name in enumerate(TRADE_REQUIRED)}
    texts = df.select("*", F.json_tuple(text, *column).alias(*column.values()))
    number = {name: f"{column[name]}_n" for name in ("E", "a", "p", "q", "T")}
    read = computed_once(
        texts,
        **{
            c: F.col(column[n]).try_cast("bigint") if n == "a" else to_double(column[n])
            for n, c in number.items()
        },
    )
    # whether the text is an object matters only when no field was found in it
    nothing = F.coalesce(*[F.col(c) for c in column.values()]).isNull()
    malformed = nothing & F.json_object_keys(text).isNull()
    rules = {"malformed": malformed}
    for name, c in column.items():
        rules[f"missing_{name}"] = _absent(c) & ~malformed
    unreadable = {
        "E": ~is_epoch_ms(number["E"]),
        "a": F.col(number["a"]).isNull(),
        "p": _not_a_number(number["p"]),
        "q": _not_a_number(number["q"]),
        "T": ~is_epoch_ms(number["T"]),
    }
    for name, bad in unreadable.items():
        rules[f"type_{name}"] = ~_absent(column[name]) & bad
    return tag_rejects(read, rules).select(
        *[F.col(c) for c in df.columns if c != payload],
        F.col(column["s"]).alias("symbol"),
        F.col(number["p"]).alias("price"),
        F.col(number["q"]).alias("quantity"),
        F.col(column["T"]).alias("event_time"),
        epoch_ms_to_ts(number["T"]).alias("event_ts"),
        F.col(number["a"]).alias("trade_id"),
        text.alias("payload"),
        REASON,
    )


def dedup_trades(ticks: DataFrame, keys: Sequence[str] = ("symbol", "trade_id")) -> DataFrame:
    """Drop replayed trades. Partial aggregation removes copies before the shuffle."""
    return ticks.dropDuplicates(list(keys))
