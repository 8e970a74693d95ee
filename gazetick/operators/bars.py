"""Market-bar features, labels, splits and sequences.

Every rolling feature runs over blocks of positions (see ``plans.position``), never over a whole
symbol, so one symbol may hold most of the table. Rolling means and counts are differences of
running sums inside a block, constant work per row; extremes and deviations use the frame itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gazetick.functions.dates import cyclic_encode, time_parts
from gazetick.functions.numeric import clip, ratio
from gazetick.operators.ordering import dedupe_keep_first
from gazetick.plans import ema
from gazetick.plans.position import BLOCK, block_window, with_blocks, with_position
from gazetick.session import stage

# The windows of each feature family.
RETURN_LAGS = (1, 5, 10, 20)
MA_WINDOWS = (5, 10, 20, 50, 100)
EMA_SPANS = (5, 10, 20, 50)
MACD_SPANS = (12, 26, 9)
VOLATILITY_WINDOWS = (5, 10, 20, 50)
VOLUME_WINDOWS = (10, 20, 50)
RANGE_WINDOWS = (10, 20, 50)
CANDLE_NAMES = ("body", "body_abs", "upper_wick", "lower_wick", "candle_range", "body_ratio", "close_position")
VWAP_NAMES = ("vwap_distance", "open_vwap_distance")
CALENDAR_NAMES = ("hour", "minute", "day_of_week", "hour_sin", "hour_cos", "minute_sin", "minute_cos")
EPS = 1e-8

KEYS = ("symbol",)
# Timestamps are unique per symbol: a bucket of 2**26 ms holds at most 1,119 one-minute bars.
TS_SHIFTS = (26,)
LONGEST_FRAME = max(MA_WINDOWS)


def prepare_bars(bars: DataFrame, n: int | None = None, keys: Sequence[str] = KEYS) -> DataFrame:
    """One row per key and timestamp; optionally the first ``n`` of every key."""
    unique = dedupe_keep_first(bars, [*keys, "timestamp"], ["date", *[c for c in bars.columns if c not in ("date", *keys)]])
    if n is None:
        return unique
    return with_position(unique, ["timestamp"], keys, TS_SHIFTS, "_pos").filter(F.col("_pos") <= n).drop("_pos")


def positioned_bars(bars: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    return with_position(bars, ["timestamp"], keys, TS_SHIFTS)


class Rolling:
    """Frames over the rows of one block."""

    def __init__(self, keys: Sequence[str] = KEYS, pos: str = "pos"):
        self.w = block_window(keys, pos)
        self.running = self.w.rowsBetween(Window.unboundedPreceding, 0)

    def lag(self, x: Column | str, k: int) -> Column:
        return F.lag(x, k).over(self.w)

    def sums(self, name: str, x: Column) -> dict[str, Column]:
        """Running sum and non-null count, the input of :meth:`mean` and :meth:`full`."""
        return {f"_sum_{name}": F.sum(x).over(self.running), f"_cnt_{name}": F.count(x).over(self.running)}

    def _moved(self, col: str, n: int) -> Column:
        return F.col(col) - F.coalesce(F.lag(col, n).over(self.w), F.lit(0))

    def full(self, name: str, n: int) -> Column:
        """True once the last ``n`` rows are all non-null."""
        return self._moved(f"_cnt_{name}", n) == n

    def mean(self, name: str, n: int) -> Column:
        return F.when(self.full(name, n), self._moved(f"_sum_{name}", n) / n)

    def over(self, agg: Column, n: int) -> Column:
        """Any aggregate over the last ``n`` rows; combine with :meth:`full`."""
        return agg.over(self.w.rowsBetween(1 - n, 0))


def candles() -> dict[str, Column]:
    o, h, low, c = (F.col(n) for n in ("open", "high", "low", "close"))
    spread = h - low
    return {
        "body": c - o,
        "body_abs": F.abs(c - o),
        "upper_wick": h - F.greatest(o, c),
        "lower_wick": F.least(o, c) - low,
        "candle_range": spread,
        "body_ratio": ratio(F.abs(c - o), spread + EPS),
        "close_position": ratio(c - low, spread + EPS),
    }


def vwap_distances() -> dict[str, Column]:
    return {
        "vwap_distance": ratio(F.col("close"), F.col("vwap")) - 1,
        "open_vwap_distance": ratio(F.col("open"), F.col("vwap")) - 1,
    }


def calendar(ts: str = "date") -> dict[str, Column]:
    parts = time_parts(F.col(ts))
    hour_sin, hour_cos = cyclic_encode(parts["hour"], 24)
    minute_sin, minute_cos = cyclic_encode(parts["minute"], 60)
    return {
        **parts,
        "hour_sin": hour_sin,
        "hour_cos": hour_cos,
        "minute_sin": minute_sin,
        "minute_cos": minute_cos,
    }


def rolling_features(blocks: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """All windowed features except the exponential averages, on the rows of ``with_blocks``.

    The layers share one sort; a layer only reads what an earlier one wrote.
    """
    r = Rolling(keys)
    close, volume = F.col("close"), F.col("volume")

    first = {f"_prev_{k}": r.lag("close", k) for k in RETURN_LAGS}
    first["_prev_volume"] = r.lag("volume", 1)
    first |= r.sums("close", close) | r.sums("volume", volume) | r.sums("high", F.col("high")) | r.sums("low", F.col("low"))
    first["_std_20"] = r.over(F.stddev_samp("close"), 20)
    for n in RANGE_WINDOWS:
        first[f"_max_{n}"] = r.over(F.max("high"), n)
        first[f"_min_{n}"] = r.over(F.min("low"), n)
    df = blocks.withColumns(first)

    prev = F.col("_prev_1")
    df = df.withColumns(
        {f"return_{k}": ratio(close, F.col(f"_prev_{k}")) - 1 for k in RETURN_LAGS}
        | {
            "log_return": F.when(ratio(close, prev) > 0, F.ln(ratio(close, prev))),
            "_gain": clip(close - prev, lower=0.0),
            "_loss": -clip(close - prev, upper=0.0),
            "_tr": F.greatest(F.col("high") - F.col("low"), F.abs(F.col("high") - prev), F.abs(F.col("low") - prev)),
            "volume_change": ratio(volume, F.col("_prev_volume")) - 1,
        }
    )

    second = {f"MA_{n}": r.mean("close", n) for n in MA_WINDOWS}
    # The bands divide by a spread that can be 0: their middle is a mean over the frame, without the
    # remainder that a difference of running sums leaves on a flat price.
    flat = r.over(F.max("close"), 20) == r.over(F.min("close"), 20)
    second["MA_20"] = F.when(r.full("close", 20), F.when(flat, close).otherwise(r.over(F.avg("close"), 20)))
    second |= {f"volume_MA_{n}": r.mean("volume", n) for n in VOLUME_WINDOWS}
    second["_std_20"] = F.when(r.full("close", 20), F.col("_std_20"))
    for n in RANGE_WINDOWS:
        second[f"_max_{n}"] = F.when(r.full("high", n), F.col(f"_max_{n}"))
        second[f"_min_{n}"] = F.when(r.full("low", n), F.col(f"_min_{n}"))
    second |= {f"volatility_{n}": r.over(F.stddev_samp("return_1"), n) for n in VOLATILITY_WINDOWS}
    second |= r.sums("gain", F.col("_gain")) | r.sums("loss", F.col("_loss")) | r.sums("tr", F.col("_tr"))
    second |= {"_cnt_return": F.count("return_1").over(r.running)}
    df = df.withColumns(second)

    third = {f"volatility_{n}": F.when(r.full("return", n), F.col(f"volatility_{n}")) for n in VOLATILITY_WINDOWS}
    third |= {"_avg_gain": r.mean("gain", 14), "_avg_loss": r.mean("loss", 14), "ATR_14": r.mean("tr", 14)}
    df = df.withColumns(third)

    middle, deviation = F.col("MA_20"), F.col("_std_20")
    upper, lower = middle + 2 * deviation, middle - 2 * deviation
    final = {f"MA_distance_{n}": ratio(close, F.col(f"MA_{n}")) - 1 for n in MA_WINDOWS}
    final |= {
        "RSI_14": 100 - 100 / (1 + F.col("_avg_gain") / (F.col("_avg_loss") + EPS)),
        "BB_middle": middle,
        "BB_upper": upper,
        "BB_lower": lower,
        "BB_width": ratio(upper - lower, middle + EPS),
        "BB_position": ratio(close - lower, upper - lower + EPS),
        "ATR_percent": ratio(F.col("ATR_14"), close),
    }
    final |= {f"volume_ratio_{n}": ratio(volume, F.col(f"volume_MA_{n}") + EPS) for n in VOLUME_WINDOWS}
    for n in RANGE_WINDOWS:
        final[f"high_distance_{n}"] = ratio(close, F.col(f"_max_{n}")) - 1
        final[f"low_distance_{n}"] = ratio(close, F.col(f"_min_{n}")) - 1
    return df.withColumns(final)


def exponential_averages(
    positioned: DataFrame,
    blocks: DataFrame,
    spans: Sequence[int],
    col: str = "close",
    keys: Sequence[str] = KEYS,
    block: int = BLOCK,
) -> DataFrame:
    """Adds ``EMA_<span>`` to the rows of ``blocks``; ``positioned`` is what they were cut from."""
    spans = tuple(dict.fromkeys(spans))
    summed = blocks.withColumns({f"_ema_{s}": ema.local_sum(F.col(col), s, keys, block=block) for s in spans})
    joined = summed.join(ema.carries(positioned, col, spans, keys, block=block), [*keys, "_block"], "left")
    averaged = joined.withColumns({f"EMA_{s}": ema.finish(F.col(f"_ema_{s}"), F.col(f"carry_{s}"), s, block=block) for s in spans})
    return averaged.drop(*[f"_ema_{s}" for s in spans], *[f"carry_{s}" for s in spans])


def macd() -> dict[str, Column]:
    """MACD columns from the averages over its three spans."""
    fast, slow, signal = MACD_SPANS
    ema_of = {s: F.col(f"EMA_{s}") for s in MACD_SPANS}
    line = ema_of[fast] - ema_of[slow]
    smooth = ema.cascade(signal, fast, ema_of[signal], ema_of[fast]) - ema.cascade(
        signal, slow, ema_of[signal], ema_of[slow]
    )
    return {"MACD": line, "MACD_signal": smooth, "MACD_hist": line - smooth}


def ema_table(
    bars: DataFrame, spans: Sequence[int], col: str = "close", keys: Sequence[str] = KEYS, block: int = BLOCK
) -> DataFrame:
    """Bars with exponential averages of one column."""
    positioned = positioned_bars(bars, keys)
    blocks = with_blocks(positioned, block=block)
    return exponential_averages(positioned, blocks, spans, col, keys, block).filter("_own").drop("_block", "_own")


def feature_names() -> list[str]:
    """The 63 derived features, grouped by family."""
    names = [f"return_{k}" for k in RETURN_LAGS] + ["log_return", *CANDLE_NAMES]
    for n in MA_WINDOWS:
        names += [f"MA_{n}", f"MA_distance_{n}"]
    names += [f"EMA_{s}" for s in EMA_SPANS] + ["RSI_14", "MACD", "MACD_signal", "MACD_hist"]
    names += ["BB_middle", "BB_upper", "BB_lower", "BB_width", "BB_position", "ATR_14", "ATR_percent"]
    names += [f"volatility_{n}" for n in VOLATILITY_WINDOWS] + ["volume_change"]
    for n in VOLUME_WINDOWS:
        names += [f"volume_MA_{n}", f"volume_ratio_{n}"]
    names += VWAP_NAMES
    for n in RANGE_WINDOWS:
        names += [f"high_distance_{n}", f"low_distance_{n}"]
    return [*names, *CALENDAR_NAMES]


def bar_features(bars: DataFrame, keys: Sequence[str] = KEYS, block: int = BLOCK) -> DataFrame:
    """Bars plus 63 features, nulls while a window is not yet full.

    Shuffles: by (key, time bucket) to number the rows, by (key, block) for all features at once.
    Bars and their numbers are staged, since several branches read them.
    """
    positioned = stage(positioned_bars(stage(bars), keys))
    blocks = with_blocks(positioned, block=block, before=LONGEST_FRAME)
    df = rolling_features(blocks, keys)
    df = exponential_averages(positioned, df, (*EMA_SPANS, *MACD_SPANS), keys=keys, block=block)
    df = df.filter("_own").withColumns(candles() | vwap_distances() | calendar() | macd())
    return df.select(*bars.columns, "pos", *feature_names())


def label_and_split(
    features: DataFrame,
    horizon: int = 5,
    train: float = 0.70,
    validation: float = 0.85,
    gap: int = 0,
    keys: Sequence[str] = KEYS,
    block: int = BLOCK,
) -> DataFrame:
    """Forward return, up/down target and a split by time within every key.

    Row-based: ``horizon`` rows ahead, whatever the clock says; the last ``horizon`` rows go.
    ``gap`` rows before each later split are dropped, since their labels look into it (0 keeps them).
    Adds ``pos`` and ``split_pos``, the 1-based place within the split.
    """
    base = stage(features.drop("pos"))  # numbering reads it more than once
    numbered = with_position(base, ["timestamp"], keys, TS_SHIFTS, total="_n")
    blocks = with_blocks(numbered, block=block, after=horizon)
    ahead = F.lead("close", horizon).over(block_window(keys))
    df = blocks.withColumn("_ahead", ahead).filter("_own").filter(F.col("pos") <= F.col("_n") - horizon)
    change = ratio(F.col("_ahead"), F.col("close")) - 1
    df = df.withColumn("future_return_5" if horizon == 5 else f"future_return_{horizon}", change)
    df = df.withColumn("target", F.coalesce(change > 0, F.col("_ahead") > 0).cast("int"))
    return chrono_split(df.withColumn("_n", F.col("_n") - horizon), "_n", train, validation, gap).drop(
        "_ahead", "_block", "_own", "_n"
    )


def chrono_split(df: DataFrame, total: str, train: float = 0.70, validation: float = 0.85, gap: int = 0) -> DataFrame:
    """``split`` and ``split_pos`` from ``pos`` and the key's row count."""
    first = F.floor(F.col(total) * F.lit(train))
    second = F.floor(F.col(total) * F.lit(validation))
    pos = F.col("pos")
    df = df.withColumns(
        {
            "split": F.when(pos <= first, "train").when(pos <= second, "validation").otherwise("test"),
            "split_pos": F.when(pos <= first, pos).when(pos <= second, pos - first).otherwise(pos - second),
        }
    )
    if gap:
        near = ((pos > first - gap) & (pos <= first)) | ((pos > second - gap) & (pos <= second))
        df = df.filter(~near)
    return df


def make_sequences(
    df: DataFrame,
    features: str | Sequence[str],
    length: int = 60,
    label: str = "target",
    keys: Sequence[str] = KEYS,
    block: int = BLOCK,
) -> DataFrame:
    """``x``: the ``length`` rows before a row, oldest first; ``y``: the row's own label.

    Only rows with ``length`` predecessors in their own split. ``features`` is an array column or a
    list of columns. The output is ``length`` times its input: keep it the last step before a model.
    """
    vector = F.col(features) if isinstance(features, str) else F.array(*[F.col(c).cast("double") for c in features])
    rows = df.select(*keys, "split", "timestamp", "pos", "split_pos", vector.alias("_v"), F.col(label).alias("y"))
    blocks = with_blocks(rows, block=block, before=length)
    frame = block_window(keys).rowsBetween(-length, -1)
    seqs = blocks.withColumn("x", F.collect_list("_v").over(frame))
    return seqs.filter(F.col("_own") & (F.col("split_pos") > length)).select(*keys, "split", "timestamp", "x", "y")
