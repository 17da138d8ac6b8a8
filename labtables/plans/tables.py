"""The five tables of the collection and its documents."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labtables import schemas
from labtables.operators import series as series_reasons
from labtables.sources import labelled, tagged
from labtables.functions.strings import file_key, file_stem, leading_word, tokens
from labtables.operators.documents import documents
from labtables.operators.enrich import Enricher, enrich_unique, fold_flags
from labtables.operators.keys import UNRESOLVED, drop_matching, keep_matching, replace_key, resolve_aliases
from labtables.operators.quality import Check, filter_valid
from labtables.operators.series import Grid, calibrate, resample_files
from labtables.operators.sources import merge_sources, tag
from labtables.operators.splits import with_levels, with_usage
from labtables.plans.registry import Registry, TableDef
from labtables.sources.labelled import parse_labelled
from labtables.sources.records import labelled_records, tagged_records
from labtables.sources.tagged import parse_tagged
from labtables.sources.text import files, lines, parse_aliases, parse_pairs, split_rejects, tagged_lines

BAD_NAME = "bad file name"
FAILED_CHECK = "failed check"
FAILED_ENRICHMENT = "failed enrichment"
UNKNOWN_ID = "unknown id"


@dataclass(frozen=True)
class Inputs:
    """Raw inputs and the two functions that know the subject matter."""

    structures: str
    aliases: str
    series_dir: str
    property_dir: str
    check: Column | Check
    enrich: Enricher
    universe_dir: str | None = None
    own_source: str = "nist"
    flags: tuple[str, ...] = schemas.FLAG_NAMES
    grid: Grid = field(default_factory=Grid)
    max_gap: int = schemas.MAX_GAP
    seed: int = 0
    check_tasks: int | None = None
    enrich_tasks: int | None = None
    buckets: int | None = None  # keeps the map of structures and the spectra in so many buckets of ``mid``
    many_records: bool = False  # files of the two folders hold records that bear their own names


def structure_map(pairs: DataFrame, aliases: DataFrame, check: Column | Check,
                  tasks: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(checked structures plus their aliases as (mid, smiles), aliases of unknown structures)."""
    parsed = parse_pairs(pairs).where(F.col("reason").isNull()).select("mid", "smiles")
    valid = filter_valid(parsed, "smiles", check, tasks)
    dup = parse_aliases(aliases).where(F.col("reason").isNull()).select("mid", "dupof")
    return resolve_aliases(dup, valid)


def measured_series(content: DataFrame, grid: Grid, max_gap: int | None) -> DataFrame:
    """(file, mid, index, vec, state, state_info, gap, reason) from files (file, content)."""
    mid, index = file_key(F.col("file"))
    vectors = resample_files(calibrate(parse_labelled(content)), grid, max_gap)
    state, info = leading_word(F.col("STATE"))
    return vectors.select(
        "file", mid.alias("mid"), index.alias("index"), "vec", state.alias("state"),
        info.alias("state_info"), "gap",
        F.coalesce(F.when(index.isNull(), BAD_NAME), F.col("reason")).alias("reason"),
    )


def measured(series: DataFrame, mapping: DataFrame) -> DataFrame:
    """The good rows of ``measured_series`` whose id is known."""
    good = series.where(F.col("reason").isNull())
    return keep_matching(good.select("mid", "index", "vec", "state", "state_info"), mapping, "mid")


def computed_properties(content: DataFrame) -> DataFrame:
    """(mid, method, freqsformat, freqs, reason) from files (file, content)."""
    return parse_tagged(content).select(
        file_stem(F.col("file")).alias("mid"), "method", "freqsformat", "freqs", "reason"
    )


def computed(properties: DataFrame, mapping: DataFrame) -> DataFrame:
    """The good rows of ``computed_properties`` under the structure of their id, once for each structure
    of it however often the map repeats a line."""
    good = properties.where(F.col("reason").isNull())
    return replace_key(good, mapping.select("mid", "smiles").distinct(), "mid", "smiles").select("smiles", "method", "freqs")


def source_keys(mapping: DataFrame, external: DataFrame | None, own_source: str) -> DataFrame:
    """(smiles, source) of the own structures and of the first token of each external line."""
    keys = tag(mapping.select("smiles"), own_source)
    if external is not None:
        first = F.get(tokens(F.col("value")), F.lit(0))
        keys = keys.unionByName(external.select(first.alias("smiles"), "source"))
    return keys.where(F.col("smiles").isNotNull())


def universe(mapping: DataFrame, external: DataFrame | None, own_source: str, fn: Enricher,
             flags: tuple[str, ...], tasks: int | None = None) -> DataFrame:
    """One row per structure of any source, with mass, flags and sorted sources.

    Sources are merged first, so the function sees each structure once.
    """
    merged = merge_sources(source_keys(mapping, external, own_source), "smiles")
    flat = T.StructType([
        T.StructField("mass", T.DoubleType()), *schemas.flag_struct(flags).fields
    ])
    return enrich_unique(merged, "smiles", fn, flat, tasks).select("smiles", "mass", fold_flags(flags), "source")


def reason_counts(*reasons: str) -> tuple[tuple[str, Column], ...]:
    """Metrics of a parsed table: its rows, the good ones and those of each reason."""
    reason = F.col("reason")
    return (("rows", F.count(F.lit(1))), ("ok", F.count_if(reason.isNull())),
            *[(r, F.count_if(reason.eqNullSafe(F.lit(r)))) for r in reasons])


SERIES_REASONS = (BAD_NAME, labelled.BAD_HEADER_LINE, labelled.BAD_NUMBER, labelled.MISSING, series_reasons.BAD_HEADER,
                  series_reasons.TOO_FEW, series_reasons.OUT_OF_RANGE, series_reasons.NO_RIGHT, series_reasons.LOW_RESOLUTION)
PROPERTY_REASONS = (tagged.NO_TAG, tagged.BAD_NUMBER)


def tables(inputs: Inputs) -> list[TableDef]:
    """Definitions of the five tables over raw files, and of the parsed files that they and the rejects
    are taken from, so that each file is parsed once."""

    def build_map(spark: SparkSession, _: dict) -> DataFrame:
        pairs, aliases = lines(spark, inputs.structures), lines(spark, inputs.aliases)
        return structure_map(pairs, aliases, inputs.check, inputs.check_tasks)[0]

    def parse_series(spark: SparkSession, _: dict) -> DataFrame:
        scan = labelled_records if inputs.many_records else files
        return measured_series(scan(spark, inputs.series_dir), inputs.grid, inputs.max_gap).drop("gap")

    def parse_properties(spark: SparkSession, _: dict) -> DataFrame:
        return computed_properties((tagged_records if inputs.many_records else files)(spark, inputs.property_dir))

    def build_universe(spark: SparkSession, t: dict) -> DataFrame:
        return universe(t["structure_map"], _external(spark, inputs), inputs.own_source, inputs.enrich, inputs.flags,
                        inputs.enrich_tasks)

    def build_usage(spark: SparkSession, t: dict) -> DataFrame:
        return with_usage(with_levels(t["measured"], t["structure_map"], t["universe"]), inputs.seed)

    grid = repr((inputs.grid, inputs.max_gap))
    external = (inputs.universe_dir,) if inputs.universe_dir else ()
    by_mid = ("mid", inputs.buckets) if inputs.buckets else None
    return [
        TableDef("structure_map", build_map, (), False, schemas.STRUCTURE_MAP, (inputs.structures, inputs.aliases),
                 buckets=by_mid),
        TableDef("parsed_series", parse_series, (), False, schemas.PARSED_SERIES, (inputs.series_dir,), grid,
                 reason_counts(*SERIES_REASONS), by_mid),
        TableDef("parsed_properties", parse_properties, (), False, schemas.PARSED_PROPERTIES, (inputs.property_dir,),
                 "", reason_counts(*PROPERTY_REASONS)),
        TableDef("measured", lambda _, t: measured(t["parsed_series"], t["structure_map"]),
                 ("parsed_series", "structure_map"), False, schemas.MEASURED, buckets=by_mid),
        TableDef("computed", lambda _, t: computed(t["parsed_properties"], t["structure_map"]),
                 ("parsed_properties", "structure_map"), False, schemas.COMPUTED),
        TableDef("universe", build_universe, ("structure_map",), True, schemas.universe(inputs.flags), external,
                 inputs.own_source),
        TableDef("usage", build_usage, ("measured", "structure_map", "universe"), False, schemas.USAGE, (),
                 str(inputs.seed)),
    ]


def _external(spark: SparkSession, inputs: Inputs) -> DataFrame | None:
    return tagged_lines(spark, inputs.universe_dir) if inputs.universe_dir else None


def rejected(pairs: DataFrame, aliases: DataFrame, series: DataFrame, properties: DataFrame, keys: DataFrame,
             mapping: DataFrame, known: DataFrame) -> DataFrame:
    """(input, line, reason) of every line, file and key that did not make it into a table.

    ``pairs`` and ``aliases`` are lines, ``series`` and ``properties`` parsed files with their reason,
    ``keys`` the (smiles, source) offered to the universe; ``mapping`` and ``known`` are the tables of
    structures and of the universe. The check and the enrichment are not run again: what they let pass is
    in those tables.
    """
    def bad(df: DataFrame, name: str, line: str, reason: str | None = None) -> DataFrame:
        df = df.where(F.col("reason").isNull()).withColumn("reason", F.lit(reason)) if reason else df
        return split_rejects(df, [], name, F.col(line))[1]

    parsed = parse_pairs(pairs)
    passed = keep_matching(parsed.where(F.col("reason").isNull()), mapping, "smiles")
    failed = drop_matching(parsed.where(F.col("reason").isNull()), mapping, "smiles")
    dup = parse_aliases(aliases)
    lost = drop_matching(dup.where(F.col("reason").isNull()), passed.select(F.col("mid").alias("dupof")), "dupof")
    unenriched = drop_matching(keys.select("smiles").distinct(), known, "smiles")
    return reduce(DataFrame.unionByName, [
        bad(parsed, "structures", "value"),
        bad(failed, "structures", "value", FAILED_CHECK),
        bad(dup, "aliases", "value"),
        bad(lost, "aliases", "mid", UNRESOLVED),
        bad(series, "series", "file"),
        bad(drop_matching(series, mapping, "mid"), "series", "file", UNKNOWN_ID),
        bad(properties, "properties", "mid"),
        bad(drop_matching(properties, mapping, "mid"), "properties", "mid", UNKNOWN_ID),
        bad(unenriched.withColumn("reason", F.lit(None).cast("string")), "universe", "smiles", FAILED_ENRICHMENT),
    ])


def rejects_table(inputs: Inputs) -> TableDef:
    """Every line, file and key that did not make it into a table, as (input, line, reason)."""

    def build(spark: SparkSession, t: dict) -> DataFrame:
        return rejected(
            lines(spark, inputs.structures), lines(spark, inputs.aliases), t["parsed_series"], t["parsed_properties"],
            source_keys(t["structure_map"], _external(spark, inputs), inputs.own_source), t["structure_map"], t["universe"],
        )

    files = (inputs.structures, inputs.aliases, *([inputs.universe_dir] if inputs.universe_dir else []))
    return TableDef("rejects", build, ("structure_map", "parsed_series", "parsed_properties", "universe"), False,
                    schemas.REJECTS, files, inputs.own_source)


def create_documents(registry: Registry, **limits: int) -> DataFrame:
    """Documents from the built tables; ``limits`` are the items per row of ``documents``."""
    t = registry.build(["structure_map", "measured", "computed", "universe"])
    return documents(t["structure_map"], t["measured"], t["computed"], t["universe"], **limits)
