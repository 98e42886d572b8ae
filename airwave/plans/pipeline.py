"""The whole job (C4).

raw log -> clean columns (once per distinct value) -> records layout, written
once -> artist and track metadata through the caches -> name normalisation ->
final write -> statistics.  The log is read twice: for the distinct values to
clean and for the records; lookups, play counts, enrichment and rename all
start from the written records.  Enrichment does not change artist names, so
plays are counted before it.  The records are not bucketed by artist: one hot
artist's bucket would be one task, while the dimensions joined to them are
broadcast or split by adaptive execution.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airwave.functions import rules
from airwave.operators import enrich, normalize, shape
from airwave.operators.cache import CacheTable
from airwave.plans import metadata, reports, sinks
from airwave.session import durable


@dataclass
class PipelineResult:
    records: DataFrame
    artist_cache: DataFrame
    track_cache: DataFrame
    mapping: DataFrame
    statistics: dict


def run(log: DataFrame, inputs_for, threshold: float | None = rules.DEFAULT_FUZZY_THRESHOLD,
        out_dir: str | None = None) -> PipelineResult:
    """The job over a log and its caches and answers.

    ``inputs_for``: the ``metadata.Inputs`` of this run, or a function that
    makes them from the table of distinct lookups (whoever fetches the answers
    needs to know what to ask for).
    """
    records = durable(shape.to_records(log))
    lookups = metadata.lookups_of(records)
    given = inputs_for(lookups) if callable(inputs_for) else inputs_for
    old_artists, old_tracks = (c if isinstance(c, CacheTable) else durable(c) for c in (given.artist_cache, given.track_cache))
    artist_cache = durable(metadata.refresh_artist_cache(lookups, old_artists, given.artist_answers, given.covers))
    track_cache = durable(metadata.refresh_track_cache(lookups, old_tracks, given.track_answers))
    enriched = enrich.enrich_tracks(enrich.enrich_artists(records, artist_cache), track_cache)
    result = normalize.normalize_artists(enriched, threshold, counted=records)
    final = result.records.drop("renamed").withColumns(
        {"created_at": F.current_timestamp(), "updated_at": F.current_timestamp()})
    if out_dir:
        sinks.save(final, f"{out_dir}/music_records", mode="overwrite")
        sinks.save(artist_cache, f"{out_dir}/artist_images", mode="overwrite")
        sinks.save(track_cache, f"{out_dir}/track_info", mode="overwrite")
        final = final.sparkSession.read.schema(final.schema).parquet(f"{out_dir}/music_records")
    return PipelineResult(final, artist_cache, track_cache, result.mapping,
                          reports.statistics(final, artist_cache, track_cache))
