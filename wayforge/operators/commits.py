"""Commit records: tables whose readers see a whole version or the one before, never half of one.

Data goes to <root>/data/version=N, and then one record is written to <root>/log/N.json under a name that only one
writer can create. Readers take the last record; what has no record was never published and is cleared by ``recover``."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def names(spark: SparkSession, path: str) -> list[str]:
    """What a folder holds; nothing if there is none."""
    at, fs = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []


def delete(spark: SparkSession, path: str) -> None:
    at, fs = _fs(spark, path)
    fs.delete(at, True)


def write_once(spark: SparkSession, path: str, text: str) -> bool:
    """Writes a small file whole or not at all; false if there is one of the name already.

    The text goes to a name of its own first and is renamed without overwriting, so no reader meets half of it."""
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    aside, fs = _fs(spark, f"{path}.{uuid.uuid4().hex[:8]}.tmp")
    out = fs.create(aside, False)
    out.write(bytearray(text.encode()))
    out.close()
    to, _ = _fs(spark, path)
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        context.rename(fs.makeQualified(aside), fs.makeQualified(to), gateway.new_array(kind, 0))
        return True
    except Exception as e:
        if not fs.exists(to):
            raise e
        fs.delete(aside, False)
        return False


def versions(spark: SparkSession, root: str) -> list[int]:
    """Versions that have a record, in order."""
    return [int(n.removesuffix(".json")) for n in names(spark, f"{root}/log") if n.endswith(".json")]


def record(spark: SparkSession, root: str, version: int) -> dict:
    at, fs = _fs(spark, f"{root}/log/{version:012d}.json")
    stream = fs.open(at)
    text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    stream.close()
    return json.loads(text)


def latest(spark: SparkSession, root: str) -> dict | None:
    """The record of the last version, with ``version``; None before the first."""
    found = versions(spark, root)
    return {**record(spark, root, found[-1]), "version": found[-1]} if found else None


def commit(spark: SparkSession, root: str, version: int, content: dict) -> bool:
    """Makes a version the current one; false if another writer has taken its number."""
    return write_once(spark, f"{root}/log/{version:012d}.json", json.dumps(content, sort_keys=True))


def recover(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Deletes data folders without a record, data that none of the last ``keep`` records names, and files set aside.

    To be run when no writer is at work; returns the names of what went."""
    found, gone = versions(spark, root), []
    named = {p for v in found[-keep:] for p in record(spark, root, v)["paths"].values()}
    for n in names(spark, f"{root}/data"):
        if not any(p == f"data/{n}" or p.startswith(f"data/{n}/") for p in named):
            delete(spark, f"{root}/data/{n}")
            gone.append(n)
    for n in names(spark, f"{root}/log"):
        if n.endswith(".tmp"):
            delete(spark, f"{root}/log/{n}")
            gone.append(n)
    return gone


def write_version(tables: dict[str, DataFrame], root: str, content: dict | None = None) -> int | None:
    """Writes tables as the version after the current one and commits it; the version, or None if another writer was first."""
    spark = next(iter(tables.values())).sparkSession
    now = latest(spark, root)
    version = now["version"] + 1 if now else 0
    paths = {}
    for name, df in tables.items():
        paths[name] = f"data/version={version}-{uuid.uuid4().hex[:8]}/{name}"
        df.write.parquet(f"{root}/{paths[name]}")
    return version if commit(spark, root, version, {**(content or {}), "paths": paths}) else None


def current(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The tables of the current version, all of one; none before the first."""
    now = latest(spark, root)
    return {name: spark.read.parquet(f"{root}/{path}") for name, path in now["paths"].items()} if now else {}
