"""Versioned artifacts: player ratings and models, with a manifest of versions.

``<root>/<name>/<version>/`` holds one artifact and is never changed once
listed. ``<root>/manifest`` is an append-only table with one row per published
version; a reader takes the newest row, so it sees a whole artifact or the
previous one, never a half-written one. Paths in it are relative to the root, which may
therefore be copied, or mounted elsewhere. ``expire`` removes versions that nothing needs
any more and folds the manifest into one file.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import TypeVar

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from swishline.operators.lookup import RatingTable
from swishline.schemas import RATINGS
from swishline.sources import files

log = logging.getLogger(__name__)

TRIED_VERSIONS = 20
# versions that load are kept at least: the one in use and those it may fall back to
KEPT_VERSIONS = 3
# a reader may hold a version this long after a newer one has come
GRACE_SECONDS = 24 * 3600
STORED_RATINGS = [*RATINGS.fieldNames(), "total"]
RATINGS_NAME, MODEL_NAME = "player_ratings", "model"

MANIFEST = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("version", T.LongType()),
        T.StructField("path", T.StringType()),
    ]
)

Loaded = TypeVar("Loaded")


@dataclass(frozen=True)
class Version:
    """A listed artifact of one root; ``path`` is relative to the root."""

    name: str
    version: int
    path: str
    root: str

    @property
    def location(self) -> str:
        return f"{self.root}/{self.path}"


def publish_ratings(ratings: DataFrame, root: str) -> Version:
    """Store the ratings, with the shots that they stand on, as a new version."""
    return _publish(
        ratings.sparkSession,
        root,
        RATINGS_NAME,
        lambda path: ratings.select(*STORED_RATINGS).write.parquet(path),
    )


def publish_model(spark: SparkSession, model: PipelineModel, root: str) -> Version:
    return _publish(spark, root, MODEL_NAME, lambda path: model.write().save(path))


def load_ratings(
    spark: SparkSession, roots: Sequence[str], current: Version | None = None
) -> tuple[Version, RatingTable] | None:
    """Newest non-empty ratings from the first root that has any; None if that is ``current``."""

    return _first_loadable(spark, roots, RATINGS_NAME, _loader(spark, RATINGS_NAME), current)


def _loader(spark: SparkSession, name: str) -> Callable[[str], Loaded]:
    """What turns the folder of a version into the artifact, or fails."""

    def ratings(path: str) -> RatingTable:
        table = RatingTable.measured(spark.read.parquet(path).select(*STORED_RATINGS))
        if table.rows == 0:
            raise ValueError("no ratings in it")
        return table

    return ratings if name == RATINGS_NAME else PipelineModel.load


def load_model(
    spark: SparkSession, roots: Sequence[str], current: Version | None = None
) -> tuple[Version, PipelineModel] | None:
    """Newest model from the first root that has one; None if that is ``current``."""
    return _first_loadable(spark, roots, MODEL_NAME, _loader(spark, MODEL_NAME), current)


def expire(
    spark: SparkSession,
    root: str,
    keep: int = KEPT_VERSIONS,
    grace_seconds: float = GRACE_SECONDS,
) -> int:
    """Remove old versions of both artifacts and fold the manifest; returns how many went.

    Of each artifact, the newest versions stay down to the ``keep``-th that loads, so the
    one that a reader uses and the ones it may fall back to are never among those
    removed; nor is one whose successor is younger than the grace. The manifest is written
    anew before the files it replaces go, so a reader finds every version that stays at
    any time. What publishers list meanwhile is left alone, and so are folders that are
    young and not listed yet. Call it once a day, from one place.
    """
    root = root.rstrip("/")
    manifest = f"{root}/manifest"
    old = files.names(spark, manifest)
    if not old:
        return 0
    rows = spark.read.schema(MANIFEST).parquet(*[f"{manifest}/{n}" for n in old])
    listed: dict[str, list[Version]] = {}
    for row in rows.distinct().orderBy(F.col("version").desc()).collect():
        listed.setdefault(row["name"], []).append(Version(**row.asDict(), root=root))
    oldest = time.time_ns() // 1000 - int(grace_seconds * 1e6)
    kept: list[Version] = []
    for name, versions in listed.items():
        kept += _needed(spark, name, versions, keep, oldest)
    if len(old) > 1 or len(kept) < sum(map(len, listed.values())):
        entries = [(v.name, v.version, v.path) for v in kept]
        spark.createDataFrame(entries, MANIFEST).coalesce(1).write.mode("append").parquet(manifest)
        for file in old:
            files.remove(spark, f"{manifest}/{file}")
    needed, gone = {v.location for v in kept}, 0
    for name in listed:
        for folder in files.folders(spark, f"{root}/{name}"):
            # the name of a folder is the time of its publication
            stale = folder.isdigit() and int(folder) < oldest
            if stale and f"{root}/{name}/{folder}" not in needed:
                files.remove(spark, f"{root}/{name}/{folder}")
                gone += 1
    return gone


def _needed(
    spark: SparkSession, name: str, versions: list[Version], keep: int, oldest: int
) -> list[Version]:
    """The versions, newest first, that stay."""
    load, loadable, kept = _loader(spark, name), 0, []
    for i, entry in enumerate(versions):
        superseded = i > 0 and versions[i - 1].version < oldest
        if loadable >= keep and superseded:
            break
        kept.append(entry)
        try:
            if loadable < keep:
                load(entry.location)
                loadable += 1
        except Exception as error:
            log.warning("%s %s: %s", name, entry.location, str(error).splitlines()[:1])
    return kept


def newest_versions(spark: SparkSession, root: str, name: str) -> list[Version]:
    """Listed versions of a root, newest first: as many as a rollback may have to try."""
    rows = (
        spark.read.schema(MANIFEST)
        .parquet(f"{root}/manifest")
        .where(F.col("name") == name)
        .orderBy(F.col("version").desc())
        .limit(TRIED_VERSIONS)
        .collect()
    )
    return [Version(**row.asDict(), root=root) for row in rows]


def _publish(
    spark: SparkSession, root: str, name: str, write: Callable[[str], None]
) -> Version:
    version = time.time_ns() // 1000
    entry = Version(name, version, f"{name}/{version}", root.rstrip("/"))
    write(entry.location)
    row = spark.createDataFrame([(entry.name, entry.version, entry.path)], MANIFEST)
    row.coalesce(1).write.mode("append").parquet(f"{root}/manifest")
    return entry


def _first_loadable(
    spark: SparkSession,
    roots: Sequence[str],
    name: str,
    load: Callable[[str], Loaded],
    current: Version | None,
) -> tuple[Version, Loaded] | None:
    """The newest version that loads, of the first root that has one.

    A version that does not load gives way to the one before it in its root. None if
    nothing loads, or if ``current``, which is in use already, comes first.
    """
    for root in (r.rstrip("/") for r in roots):
        try:
            versions = newest_versions(spark, root, name)
        except Exception as error:  # a bad root must not stop a running scorer
            log.warning("no %s from %s: %s", name, root, str(error).splitlines()[:1])
            continue
        for entry in versions:
            if entry == current:
                return None
            try:
                return entry, load(entry.location)
            except Exception as error:
                log.warning("%s %s: %s", name, entry.location, str(error).splitlines()[:1])
    return None
