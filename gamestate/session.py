"""Sessions, and getting the package to the executors."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

_ROOT = Path(__file__).resolve().parent


def build(app: str = "gamestate", **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; conf overrides, with dots written as two underscores."""
    b = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true")
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    return b.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once for each context; Python workers may run where it isn't installed."""
    sc = spark.sparkContext
    if getattr(sc, "_gamestate_shipped", False):
        return
    path = Path(tempfile.mkdtemp()) / "gamestate_package.zip"
    with zipfile.ZipFile(path, "w") as z:
        for p in sorted(_ROOT.rglob("*.py")):
            z.write(p, Path(_ROOT.name) / p.relative_to(_ROOT))
    sc.addPyFile(str(path))
    sc._gamestate_shipped = True


def together[T, R](spark: SparkSession, f: Callable[[T], R], items: Iterable[T]) -> list[R]:
    """f of each item, at once: jobs too small for all cores share them. f must not change the session's settings."""
    items = list(items)
    with ThreadPoolExecutor(max(len(items), 1)) as pool:
        return [x.result() for x in [pool.submit(inheritable_thread_target(spark)(f), i) for i in items]]
