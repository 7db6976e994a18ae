"""Sinks: tables, JSON lines, reports."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def write_table(df: DataFrame, path: str | Path, partition_by: list[str] | None = None) -> None:
    """Parquet by suffix, else CSV; overwrites; the target is a directory."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if str(path).rstrip("/").endswith(".parquet"):
        writer.parquet(str(path))
    else:
        writer.option("header", True).option("escape", '"').csv(str(path))


def publish(spark: SparkSession, staged: str | Path, final: str | Path) -> None:
    """Puts the finished table ``staged`` in the place of ``final``, on any file system Hadoop knows.

    The old table is set aside until the new one is in place; ``restore`` brings it back
    if the job ended in between.
    """
    fs, new, old, aside = _places(spark, staged, final)
    restore(spark, final)
    if fs.exists(old) and not fs.rename(old, aside):
        raise OSError(f"cannot set {final} aside")
    if not fs.rename(new, old):
        restore(spark, final)
        raise OSError(f"cannot publish {final}")
    fs.delete(aside, True)


def restore(spark: SparkSession, final: str | Path) -> None:
    """Undoes a publication that ended half-way: the table set aside returns, or goes if the new one is there."""
    fs, _, old, aside = _places(spark, final, final)
    if fs.exists(aside):
        if fs.exists(old):
            fs.delete(aside, True)
        elif not fs.rename(aside, old):
            raise OSError(f"cannot restore {final}")


def _places(spark: SparkSession, staged: str | Path, final: str | Path) -> tuple:
    path = spark._jvm.org.apache.hadoop.fs.Path
    old = path(str(final))
    return old.getFileSystem(spark._jsc.hadoopConfiguration()), path(str(staged)), old, path(old.getParent(), f"_aside_{old.getName()}")


def write_jsonl(df: DataFrame, path: str | Path) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", False).json(str(path))


def markdown_table(df: DataFrame, limit: int = 200) -> str:
    """A report table; reports are small, and ``limit`` keeps them so."""
    rows = df.limit(limit).collect()
    lines = ["| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
    lines += ["| " + " | ".join("" if v is None else str(v).replace("|", "\\|") for v in r) + " |" for r in rows]
    return "\n".join(lines)


def write_text(text: str, path: str | Path) -> None:
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


def bar_chart(rows: list[tuple[str, float]], path: str | Path, title: str) -> bool:
    """Draws a bar chart where a plotting library is installed; tells whether it did."""
    try:
        import matplotlib

        matplotlib.use("Agg")
        import matplotlib.pyplot as plt
    except ImportError:
        return False
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    figure, axes = plt.subplots(figsize=(6, 4))
    axes.bar([str(k) for k, _ in rows], [v for _, v in rows])
    axes.set_title(title)
    figure.tight_layout()
    figure.savefig(path, dpi=120)
    plt.close(figure)
    return True
