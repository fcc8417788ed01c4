"""Readers and writers of transfer files: canonical rows from CSV, captured logs, JSON lines and snapshots.

Canonical file rows: ``block`` long, ``ts`` long (seconds, null if unknown), ``tx`` string, ``li`` long, ``frm``,
``dst`` string, ``value`` string of decimal digits (256 bits don't fit any number), ``block_hash`` string,
and ``valid``: whether all fields could be read. ``narrow`` turns valid rows into ledger rows.
"""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.sources.adapters import DEAD, ZERO

# The two sink addresses as they stand in files, the columns of both CSV layouts, digits that a decimal holds.
ZERO_ADDRESS = "0x" + "0" * 40
DEAD_ADDRESS = "0x" + "0" * 36 + "dead"
STANDARD = ["block", "ts", "tx", "log_index", "from", "to", "value_raw", "block_hash"]
LEGACY = ["block", "ts", "tx", "from", "to", "value_raw", "uniqueId"]
NARROW_DIGITS = 37
CANONICAL = ["block", "ts", "tx", "li", "frm", "dst", "value", "block_hash", "valid"]


def _glob(spark: SparkSession, pattern: str) -> list[str]:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return [f.getPath().toString() for f in found or []]


def read_transfers(spark: SparkSession, path: str) -> DataFrame:
    """Canonical rows of a file or folder: captured logs where there is a ``logs.parquet``, canonical Parquet, else CSV."""
    base = path.rstrip("/")
    if _glob(spark, f"{base}/run_*/logs.parquet") or _glob(spark, f"{base}/logs.parquet"):
        return read_logs(spark, base)
    if base.endswith("logs.parquet"):
        return read_logs(spark, base.rsplit("/", 1)[0])
    if base.endswith(".parquet"):
        return read_canonical(spark, base)
    return read_csv(spark, base)


def seconds(ts: Column) -> Column:
    """Seconds from an ISO time or a whole number of seconds or milliseconds."""
    number = ts.cast("string").try_cast("long")
    whole = F.when(number > 10**12, F.floor(number / 1000)).otherwise(number)
    return F.coalesce(whole, F.unix_timestamp(ts.cast("string").try_cast("timestamp")))


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """Canonical rows of CSV, by the names in its header; rows whose block is no number are no rows."""
    raw = spark.read.option("header", True).option("mode", "PERMISSIVE").csv(path)
    if "uniqueId" in raw.columns:
        digits = F.regexp_extract("uniqueId", ":([0-9]+)$", 1)
        li = F.when(digits != "", digits).when(~F.col("uniqueId").contains(":"), "0").try_cast("long")
    else:
        li = F.col("log_index").try_cast("long")
    value = F.col("value_raw")
    rows = raw.filter(F.col("block").rlike("^[0-9]+$")).select(
        F.col("block").try_cast("long").alias("block"),
        seconds(F.col("ts")).alias("ts"),
        F.col("tx").alias("tx"),
        li.alias("li"),
        F.lower("from").alias("frm"),
        F.lower("to").alias("dst"),
        F.when(value.rlike("^[0-9]+$"), F.regexp_replace(value, "^0+(?=[0-9])", "")).alias("value"),
        (F.coalesce(F.col("block_hash"), F.lit("")) if "block_hash" in raw.columns else F.lit("")).alias("block_hash"),
    )
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in ("block", "tx", "li", "frm", "dst", "value")])
    return rows.withColumn("valid", known).select(*CANONICAL)


def word(data: Column) -> Column:
    """Decimal digits of a 32-byte word ``0x...``; empty data is zero, anything else that is no hexadecimal number null.

    Words below 2^126 are read by built-in functions; only wider ones go to Python.
    """

    @F.pandas_udf("string")
    def wide(hex_: pd.Series) -> pd.Series:
        return pd.Series([None if x is None else str(int(x, 16)) for x in hex_], dtype=object)

    body = F.when(data.isNull() | data.isin("", "0x"), "0").when(data.rlike("^0x[0-9a-fA-F]{1,64}$"), F.substring(data, 3, 64))
    full = F.lpad(body, 64, "0")
    limb = lambda at: F.conv(F.substring(full, at, 16), 16, 10).cast("decimal(20,0)")
    low = (limb(33) * F.lit(str(2**64)).cast("decimal(20,0)")).cast("decimal(38,0)") + limb(49)
    fits = full.rlike("^0{32}[0-3]")
    return F.when(fits, low.cast("decimal(38,0)").cast("string")).otherwise(wide(F.when(~fits, full)))


def read_logs(spark: SparkSession, path: str, keep_unknown_time: bool = True) -> DataFrame:
    """Canonical rows of captured logs with topics and 32-byte data, in ``run_*`` folders or in ``path`` itself.

    Times come from ``blocks.parquet``; without one a row's time is null, or the row is left out.
    """
    runs = "run_*/" if _glob(spark, f"{path}/run_*/logs.parquet") else ""
    logs = spark.read.option("mergeSchema", True).parquet(f"{path}/{runs}logs.parquet")
    lacking = {"block_number", "log_index", "transaction_hash", "topic1", "topic2"} - set(logs.columns)
    if lacking:
        raise ValueError(f"columns missing in {path}: {sorted(lacking)}")
    address = lambda c: F.concat(F.lit("0x"), F.lower(F.substring(F.coalesce(F.col(c), F.lit("0" * 64)), -40, 40)))
    rows = logs.select(
        F.col("block_number").cast("long").alias("block"),
        F.col("transaction_hash").alias("tx"),
        F.col("log_index").cast("long").alias("li"),
        address("topic1").alias("frm"),
        address("topic2").alias("dst"),
        (word(F.col("data")) if "data" in logs.columns else F.lit("0")).alias("value"),
        (F.coalesce(F.col("block_hash"), F.lit("")) if "block_hash" in logs.columns else F.lit("")).alias("block_hash"),
    )
    if _glob(spark, f"{path}/{runs}blocks.parquet"):
        rows = rows.join(block_times(spark.read.option("mergeSchema", True).parquet(f"{path}/{runs}blocks.parquet")), "block", "left" if keep_unknown_time else "inner")
    else:
        rows = rows.withColumn("ts", F.lit(None).cast("long"))
    return rows.withColumn("valid", F.col("value").isNotNull() & F.col("block").isNotNull() & F.col("tx").isNotNull() & F.col("li").isNotNull()).select(*CANONICAL)


def block_times(blocks: DataFrame) -> DataFrame:
    """(block, ts), one row a block, from (number, timestamp); the time is a number or hexadecimal text."""
    text = F.col("timestamp").cast("string")
    ts = F.when(text.startswith("0x"), F.conv(F.substring(text, 3, 16), 16, 10)).otherwise(text).try_cast("long")
    return blocks.filter("number is not null").groupBy(F.col("number").cast("long").alias("block")).agg(F.max(ts).alias("ts"))


def width_probe(rows: DataFrame) -> DataFrame:
    """One row (rows, wide, longest, narrow): whether all amounts fit a decimal of 38 digits when they are added up."""
    out = rows.agg(F.count("*").alias("rows"), F.count_if(F.length("value") > NARROW_DIGITS).alias("wide"), F.coalesce(F.max(F.length("value")), F.lit(0)).alias("longest"))
    return out.withColumn("narrow", F.col("wide") == 0)


def narrow(rows: DataFrame) -> DataFrame:
    """Ledger rows (block, ts, tx, li, frm, dst, v) of valid rows; an amount over 38 digits raises, nothing is rounded."""
    end = lambda c: F.when(F.col(c) == ZERO_ADDRESS, ZERO).when(F.col(c) == DEAD_ADDRESS, DEAD).otherwise(F.col(c)).alias(c)
    return rows.filter("valid").select("block", "ts", "tx", "li", end("frm"), end("dst"), F.col("value").cast("decimal(38,0)").alias("v"))


def channels(parts: list[tuple[str, DataFrame, int | None, int | None]]) -> DataFrame:
    """All rows of (tag, rows, lo, hi) with their ``tag`` and ``inside``: whether the channel owns the block, ``[lo, hi)``."""
    tagged = []
    for tag, rows, lo, hi in parts:
        inside = F.lit(True)
        inside = inside & (F.col("block") >= lo) if lo is not None else inside
        inside = inside & (F.col("block") < hi) if hi is not None else inside
        tagged.append(rows.withColumns({"tag": F.lit(tag), "inside": inside}))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def tolerated(rejects: DataFrame, bad_rows: int) -> DataFrame:
    """The one row of ``ledger.rejects`` with ``passes`` under an allowance of bad rows."""
    return rejects.withColumn("passes", (F.col("n_bad_fields") <= bad_rows) & (F.col("n_out_of_segment") == 0))


def write_csv(rows: DataFrame, path: str, legacy: bool = False) -> None:
    """Canonical rows as CSV in the standard or the legacy layout."""
    names = {"li": "log_index", "frm": "from", "dst": "to", "value": "value_raw"}
    out = rows.withColumnsRenamed(names)
    if legacy:
        out = out.withColumn("uniqueId", F.concat("tx", F.lit(":log:"), "log_index"))
    out.select(*(LEGACY if legacy else STANDARD)).write.option("header", True).csv(path)


def write_parquet(rows: DataFrame, path: str, order: bool = False) -> None:
    """Canonical rows as Parquet; ``order``: files hold ranges of (block, li), sorted within."""
    out = rows.select(*CANONICAL[:-1])
    out = out.repartitionByRange("block", "li").sortWithinPartitions("block", "li") if order else out
    out.write.option("compression", "zstd").parquet(path)


def read_canonical(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).withColumn("valid", F.lit(True)).select(*CANONICAL)


def read_edge_lines(spark: SparkSession, path: str) -> DataFrame:
    """(ts, slot, tx_index, instr_index, frm, dst, v, line, valid) of JSON lines ``[ts, slot, tx, instr, from, to, amount]``, plain or gzipped.

    A line is valid if it has seven elements of the right kinds: whole numbers without leading
    zeros, -1 only for an unknown instruction, two names and a positive amount.
    """
    parts = F.from_json("value", "array<string>")
    lines = spark.read.text(path).filter(F.trim("value") != "").select(F.col("value").alias("line"), parts.alias("p"))
    whole = lambda k: F.when(F.get("p", F.lit(k)).rlike("^(0|[1-9][0-9]*)$"), F.get("p", F.lit(k)))
    name = lambda k: F.when(F.length(F.get("p", F.lit(k))) > 0, F.get("p", F.lit(k)))
    rows = lines.select(
        "line",
        (F.size("p") == 7).alias("seven"),
        *[whole(k).try_cast("long").alias(c) for k, c in enumerate(("ts", "slot", "tx_index"))],
        F.when(F.get("p", F.lit(3)) == "-1", F.lit(-1).cast("long")).otherwise(whole(3).try_cast("long")).alias("instr_index"),
        name(4).alias("frm"),
        name(5).alias("dst"),
        whole(6).try_cast("decimal(38,0)").alias("v"),
    )
    good = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in ("ts", "slot", "tx_index", "instr_index", "frm", "dst", "v")])
    return rows.withColumn("valid", F.coalesce(F.col("seven") & good & (F.col("v") > 0), F.lit(False))).drop("seven")


def digest(rows: DataFrame, line: Column) -> DataFrame:
    """One row (rows, digest): number and sum of hashes of the lines, the same for any order and any cut into files."""
    value = F.conv(F.substring(F.md5(line), 1, 15), 16, 10).cast("decimal(38,0)")
    return rows.agg(F.count("*").alias("rows"), F.coalesce(F.sum(value), F.lit(0)).cast("decimal(38,0)").alias("digest"))


def read_holders(accounts: DataFrame) -> DataFrame:
    """(owner, balance) of (pubkey, data): base64 of 32 bytes of owner and 8 bytes of amount, low byte first.

    Each pubkey counts once; malformed data and zero sums are left out. The owner is in hexadecimal.
    """
    hex_ = F.hex(F.unbase64("data"))
    amount = F.concat(*[F.substring(hex_, 65 + 2 * k, 2) for k in range(7, -1, -1)])
    rows = accounts.withColumn("data", F.when(F.col("data").rlike("^[A-Za-z0-9+/]{54}==$|^[A-Za-z0-9+/]{53}=$|^[A-Za-z0-9+/]{56}$|^[A-Za-z0-9+/]{54}$"), F.col("data")))
    rows = rows.groupBy("pubkey").agg(F.max("data").alias("data")).filter(F.length(hex_) == 80)
    out = rows.select(F.lower(F.substring(hex_, 1, 64)).alias("owner"), F.conv(amount, 16, 10).cast("decimal(38,0)").alias("v"))
    return out.groupBy("owner").agg(F.sum("v").alias("balance")).filter("balance > 0")


def last_wins(rows: DataFrame, key: str, arrival: str) -> DataFrame:
    """One row for each ``key``, the one that arrived last."""
    return rows.groupBy(key).agg(F.max(F.struct(arrival, *[c for c in rows.columns if c not in (key, arrival)])).alias("_row")).select(key, "_row.*").select(*rows.columns)


def read_prices(rows: DataFrame, ts: str, price: str) -> DataFrame:
    """(ts, price): seconds, whatever the unit; one price a time, the largest of equal times; bad rows left out."""
    found = rows.select(seconds(F.col(ts)).alias("ts"), F.col(price).cast("string").try_cast("double").alias("price"))
    return found.filter("ts is not null and price > 0").groupBy("ts").agg(F.max("price").alias("price"))


#: Names, in lower case, under which columns of time and price are found, the first that is there.
TIME_NAMES = ("ts", "timestamp", "time", "date")
PRICE_NAMES = ("price", "close")


def found_column(columns: list[str], names: tuple[str, ...]) -> str:
    """The column that has one of the names, whatever its case; raises if none has."""
    known = {c.strip().lower(): c for c in reversed(columns)}
    for name in names:
        if name in known:
            return known[name]
    raise ValueError(f"none of {names} among the columns {columns}")


def read_price_file(spark: SparkSession, path: str) -> DataFrame:
    """(ts, price) of CSV with columns of time and price by their names, or of JSON documents ``[[ts, price], …]`` or ``{"prices": [[ts, price], …]}``.

    A JSON document is one row of one task, as it is one value. A document of another shape raises, and so do several in one file.
    """
    if not path.rstrip("/").endswith(".json"):
        rows = spark.read.option("header", True).csv(path)
        return read_prices(rows, found_column(rows.columns, TIME_NAMES), found_column(rows.columns, PRICE_NAMES))
    text = spark.read.option("wholetext", True).text(path)
    pairs = "array<array<string>>"
    shape = F.coalesce(F.from_json("value", f"struct<prices:{pairs}>")["prices"], F.when(F.ltrim("value").startswith("["), F.from_json("value", pairs)))
    # Pairs hold no brackets but their own, so an end without a comma before the next start is that of a whole document.
    shape = F.when(~F.col("value").rlike(r"[\]}]\s*[\[{]"), shape)
    pair = F.explode(F.coalesce(shape, F.raise_error(F.lit(f"{path}: neither a list of pairs nor prices")).cast(pairs))).alias("p")
    return read_prices(text.select(pair).select(F.get("p", F.lit(0)).alias("t"), F.get("p", F.lit(1)).alias("v")), "t", "v")


def read_labels(spark: SparkSession, *paths: str) -> DataFrame:
    """Label rows of CSV files in layers, of which later ones override earlier ones (privacy tables first, main tables after them); missing columns are empty.

    Within a file the last row of an address counts. Addresses are trimmed, and lower-cased where they are hexadecimal.
    """
    from ledgerspark.operators.labels import layered

    columns = "address chain name category tier source added_date evidence risk_flags merge_policy balance_policy source_snapshot_at verified_at status".split()
    layers = []
    for path in paths:
        raw = spark.read.option("header", True).csv(path)
        own = {c.strip().lower(): c for c in raw.columns}
        rows = raw.select(*[(F.coalesce(F.col(f"`{own[c]}`"), F.lit("")) if c in own else F.lit("")).alias(c) for c in columns], F.monotonically_increasing_id().alias("arrival"))
        address = F.trim("address")
        layers.append(rows.withColumn("address", F.when(address.rlike("^0[xX][0-9a-fA-F]{40}$"), F.lower(address)).otherwise(address)).filter("address <> ''"))
    return layered(*layers).drop("arrival")
