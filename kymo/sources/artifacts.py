"""CSV, JSON and window tables on any file system Spark knows; every check names what it found."""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

#: Version of the layout that ``write_windows`` leaves.
WINDOW_SCHEMA = "window_outputs_v1"
#: Columns that every window table has to hold, and those that all its rows share.
WINDOW_COLUMNS = ["sample_name", "target", "window_index", "start_sec", "end_sec", "prob_raw", "pred_raw", "quality", "ood_rate"]
CONTRACT = ["schema_version", "model_threshold", "window_sec", "stride_sec", "model_fingerprint", "feature_names"]
_LAYOUT = (
    "sample_name string, target int, window_index bigint, start_sec double, end_sec double, prob_raw double, pred_raw int, quality double, ood_rate double, "
    "schema_version string, model_threshold double, window_sec double, stride_sec double, model_fingerprint string, feature_names string, split string"
)


def write_csv(df: DataFrame, path: str) -> None:
    """Header, quotes doubled inside quoted fields; null is an empty field, an empty text is ``""``."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").csv(path)


def read_csv(spark: SparkSession, path: str, schema: StructType | str, multiline: bool = True) -> DataFrame:
    """Read what ``write_csv`` wrote; ``multiline=False`` lets Spark split files whose texts hold no line break."""
    rows = spark.read.option("header", True).option("escape", '"').option("emptyValue", "\0").option("multiLine", multiline).option("mode", "FAILFAST").option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").schema(schema).csv(path)
    texts = [f.name for f in rows.schema if isinstance(f.dataType, StringType)]
    return rows.withColumns({c: F.when(F.col(c) == "\0", "").otherwise(F.col(c)) for c in texts})  # else "" would be read as null


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _plain(x: Any) -> Any:
    if isinstance(x, Mapping):
        return {str(k): _plain(v) for k, v in x.items()}
    if isinstance(x, (list, tuple, set)):
        return [_plain(v) for v in x]
    if hasattr(x, "item"):  # NumPy scalars
        x = x.item()
    return None if isinstance(x, float) and not math.isfinite(x) else x


def write_json(spark: SparkSession, path: str, content: Any) -> None:
    """Write a small artifact beside its place, then rename it there, so that readers see the old one or the new one; numbers that are not finite become null."""
    jvm, (target, fs) = spark.sparkContext._jvm, _path(spark, path)
    part, _ = _path(spark, f"{path}.{uuid.uuid4().hex}.part")
    out = fs.create(part, True)
    out.write(bytearray(json.dumps(_plain(content), ensure_ascii=False, indent=2).encode()))
    out.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(fs.makeQualified(part), fs.makeQualified(target), how)


def read_json(spark: SparkSession, path: str | None) -> Any:
    """The artifact, or an empty dict where there is none."""
    if not path:
        return {}
    p, fs = _path(spark, path)
    if not fs.exists(p):
        return {}
    stream = fs.open(p)
    try:
        return json.loads(bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)))
    finally:
        stream.close()


def latest(spark: SparkSession, patterns: Iterable[str]) -> str | None:
    """Last path by name of the first pattern that matches any."""
    for pattern in patterns:
        p, fs = _path(spark, pattern)
        if found := sorted(s.getPath().toString() for s in fs.globStatus(p) or []):
            return found[-1]
    return None


def write_windows(windows: DataFrame, path: str, window_sec: float, stride_sec: float, threshold: float, fingerprint: Mapping | None = None, features: Iterable[str] = ()) -> None:
    """Window outputs, one folder a ``split``; only the splits written now are replaced.

    Missing times follow from the index, missing predictions from the threshold; quality is 1 and the out-of-range rate 0 where absent or not finite.
    """
    has = lambda c, default: F.coalesce(F.col(c), default) if c in windows.columns else default
    finite = lambda c: F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)
    start = has("start_sec", F.col("window_index") * F.lit(float(stride_sec)))
    rate = F.coalesce(finite(F.col("ood_rate")), F.lit(0.0)) if "ood_rate" in windows.columns else F.lit(0.0)
    shared = [WINDOW_SCHEMA, float(threshold), float(window_sec), float(stride_sec), json.dumps(_plain(fingerprint or {}), sort_keys=True), json.dumps(list(features))]
    rows = windows.select(
        "split", F.col("sample_name").cast("string"), F.col("target").cast("int"), F.col("window_index").cast("long"), start.cast("double").alias("start_sec"),
        has("end_sec", start + float(window_sec)).cast("double").alias("end_sec"), F.col("prob_raw").cast("double"), has("pred_raw", (F.col("prob_raw") >= float(threshold)).cast("int")).alias("pred_raw"),
        has("quality", F.lit(1.0)).cast("double").alias("quality"), rate.alias("ood_rate"), *[F.lit(v).alias(c) for c, v in zip(CONTRACT, shared, strict=True)],
    )
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("split").parquet(path)


def contract_faults(windows: DataFrame, expected: Mapping[str, Any] | None = None) -> list[str]:
    """What breaks the contract of a window table: one aggregated row comes to the driver, whatever its size."""
    if missing := [c for c in (*WINDOW_COLUMNS, *CONTRACT) if c not in windows.columns]:
        return [f"missing columns {missing}"]
    bad = lambda c: F.isnan(c) | (F.abs(c) == float("inf"))
    scalars = ["model_threshold", "window_sec", "stride_sec"]
    checks = [F.min(c).alias(f"lo_{c}") for c in CONTRACT] + [F.max(c).alias(f"hi_{c}") for c in CONTRACT]
    checks += [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in (*WINDOW_COLUMNS, *CONTRACT)]
    checks += [F.count_if(bad(c)).alias(f"bad_{c}") for c in scalars]
    row = windows.agg(F.count(F.lit(1)).alias("n"), *checks).first()
    if not row["n"]:
        return ["no windows"]
    faults = [f"{c} has nulls" for c in (*WINDOW_COLUMNS, *CONTRACT) if row[f"null_{c}"]]
    faults += [f"mixed {c}" for c in CONTRACT if row[f"lo_{c}"] != row[f"hi_{c}"]]
    faults += [f"{c} is not finite" for c in scalars if row[f"bad_{c}"]]
    faults += [f"{c} is not positive" for c in scalars[1:] if row[f"lo_{c}"] is not None and row[f"lo_{c}"] <= 0]
    for c, want in ({"schema_version": WINDOW_SCHEMA} | dict(expected or {})).items():
        want = want if isinstance(want, (str, float)) else json.dumps(_plain(want), sort_keys=isinstance(want, Mapping))
        if row[f"lo_{c}"] != want:
            faults.append(f"{c} is {row[f'lo_{c}']!r}, not {want!r}")
    return faults


def read_windows(spark: SparkSession, path: str, split: str, expected: Mapping[str, Any] | None = None, required: bool = True) -> DataFrame:
    """Windows of one split, after the check of their contract (and of the model's, where ``expected`` gives it); a column that files lack reads as nulls.

    A split without windows is a fault where it is ``required``.
    """
    rows = spark.read.schema(_LAYOUT).parquet(path).where(F.col("split") == split)
    faults = contract_faults(rows, expected)
    if faults and (required or faults != ["no windows"]):
        raise ValueError(f"{path}, split {split}: " + "; ".join(faults))
    return rows


def freeze_search(spark: SparkSession, folder: str, best: Mapping[str, Any], split: str, constraints: Mapping[str, Any], provenance: Mapping[str, Any] | None = None) -> dict:
    """Write the chosen state-machine parameters, and put them into the model's own configuration, whose other entries stay."""
    given = {k.removeprefix("param_"): v for k, v in best.items() if k.startswith("param_")}
    metrics = {k: float(v) for k, v in best.items() if not k.startswith("param_") and isinstance(v, (int, float))}
    chosen = {"source": "search", "split": split, "constraints": dict(constraints), "metrics": metrics, "postprocess": given, "cache_provenance": dict(provenance or {})}
    write_json(spark, f"{folder}/postprocess_optimized.json", chosen)
    config = read_json(spark, f"{folder}/final_model_config.json")
    config |= {"postprocess": given, "postprocess_optimization": {k: v for k, v in chosen.items() if k != "postprocess"}}
    write_json(spark, f"{folder}/final_model_config.json", config)
    return config
