"""Ingest jobs: sources -> utterance lake, with failed clips set aside."""

from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import ExitStack, contextmanager, nullcontext
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from speechlake.functions.codec import DEFAULT_DECODERS
from speechlake.operators.audio import ingest_audio, to_int8_list
from speechlake.operators.blocks import BlockBudget
from speechlake.operators.join import join_audio
from speechlake.operators.project import SPLIT_NAMES, drop_unlabeled, set_language, to_lake_schema
from speechlake.operators.quality import enforce_budget, split_good_bad
from speechlake.operators.ranking import number_slice, ranked
from speechlake.operators.sample import SEED, cap_per_group, carve_splits, eval_head, skip_take
from speechlake.schemas import CLIP_KEY, LAKE_COLUMNS
from speechlake.session import staged
from speechlake.sources.corpora import archive_listing, list_shards, missing_archives, read_archives, read_clips, read_manifest
from speechlake.sources.tables import ROW_GROUP_ROWS, has_data, landed_keys, quarantine_new, write_lake

# The split folders of a source.
SOURCE_SPLITS = ["train", "validation", "test"]


def sample_round(
    clips: DataFrame, split: str, skip: int = 0, take: int = 0, seed: int = SEED, key: str = "clip_key"
) -> DataFrame:
    """The clips of one source split that belong to a round.

    Train gives the seeded chunk ``skip + 1 .. skip + take``; the evaluation splits give their fixed head in the first
    round and nothing later.
    """
    if split == "train":
        return skip_take(clips, key, skip, take, seed)
    in_order = F.struct(F.col("file"), number_slice("row"))
    return eval_head(clips, [], ["file", "row"], in_order, skip, take)


def ingest_round(
    clips: DataFrame, round_no: int, take: int, key: str, by: list[str] = (), seed: int = SEED, done: DataFrame | None = None
) -> DataFrame:
    """Train rows of round ``round_no`` (from 0): disjoint chunks of ``take`` rows per source in seeded order.

    With ``done`` (keys already landed), a rerun adds only what is missing.
    """
    rows = skip_take(clips, key, round_no * take, take, seed, list(by))
    return rows if done is None else rows.join(done.select(key), key, "left_anti")


def land(
    clips: DataFrame, decode: Callable[[DataFrame], DataFrame], name: Callable[[DataFrame], DataFrame], out: str, corpus: str,
    language: str, quarantine: str | None = None, max_bad: int | None = None, staged_rows: bool = False,
    budget: BlockBudget | None = None,
) -> int:
    """Decode the clips that the lake does not hold yet and append them; returns the rows landed.

    ``clips`` have a ``clip_key``, which the lake keeps, so a round or a batch that runs again adds only what is missing.
    ``decode`` adds ``error``; ``name`` gives good rows their lake columns. Failed clips and their reason go to
    ``quarantine``, once. Decoded audio goes straight to its place; the few failed clips are then decoded again for
    their reasons. If ``max_bad`` is set and more clips fail, nothing lands; for that, all is decoded into the shared scratch
    folder first, where ``decode`` has put it itself under ``staged_rows``. ``budget`` is that of the blocks which ``decode`` counts: the run ends as
    soon as more are lost, before all is decoded, and nothing lands.
    """
    spark = clips.sparkSession
    new = clips.join(landed_keys(spark, out, corpus, language), CLIP_KEY, "left_anti").select(*clips.columns)
    decoded = decode(new)
    if staged_rows or max_bad is not None or budget is not None:
        with nullcontext(decoded) if staged_rows else _watched(decoded, budget) as rows:
            good, bad = split_good_bad(enforce_budget(rows, max_bad=max_bad))
            if quarantine:
                quarantine_new(bad.select(*LOST_COLUMNS), quarantine)
            return _append(name(good), out)
    seen = Observation("decoded")
    good = decoded.observe(seen, F.count_if(F.col("error").isNotNull()).alias("bad"))
    landed = _append(name(split_good_bad(good)[0]), out)
    if quarantine and seen.get["bad"]:
        left = new.join(landed_keys(spark, out, corpus, language), CLIP_KEY, "left_anti").select(*new.columns)
        quarantine_new(split_good_bad(decode(left))[1].select(*LOST_COLUMNS), quarantine)
    return landed


@contextmanager
def _watched(decoded: DataFrame, budget: BlockBudget | None) -> Iterator[DataFrame]:
    """``decoded`` in the scratch folder, written within the budget."""
    with ExitStack() as stack:
        with budget.watch() if budget else nullcontext():
            rows = stack.enter_context(staged(decoded, "decoded", ROW_GROUP_ROWS))
        yield rows


def _append(rows: DataFrame, out: str) -> int:
    counted = Observation("landed")
    write_lake(rows.observe(counted, F.count(F.lit(1)).alias("rows")), out, spread=False)
    return counted.get["rows"]


LOST_COLUMNS = [CLIP_KEY, "corpus", "language", "error"]


def ingest_clips(
    spark: SparkSession, root: str, out: str, language: str, corpus: str, skip: int = 0, take: int = 0, seed: int = SEED,
    decoders=DEFAULT_DECODERS, quarantine: str | None = None, max_bad: int | None = None, int8_list: bool = False,
    max_bad_blocks: int | None = None,
) -> int:
    """Ingest one source that has split folders of clip tables; clips that the lake holds are not landed again.

    ``int8_list`` lands the audio as ARRAY<TINYINT>, which some readers of the lake take.
    """
    splits = SOURCE_SPLITS if skip == 0 else ["train"]
    parts = []
    for split in splits:
        rows = sample_round(read_clips(spark, root, split), split, skip, take, seed)
        named = set_language(rows, language).withColumn("split", F.lit(SPLIT_NAMES.get(split, split)))
        key = F.concat_ws("#", F.lit(split), "clip_key").alias(CLIP_KEY)
        parts.append(named.select(key, "transcription", "language", "split", F.col("audio.bytes").alias("audio_bytes")))
    clips = reduce(DataFrame.unionByName, parts).withColumn("corpus", F.lit(corpus))

    def name(good: DataFrame) -> DataFrame:
        rows = to_lake_schema(good, F.col("split"), corpus, [CLIP_KEY])
        return to_int8_list(rows) if int8_list else rows

    budget = None if max_bad_blocks is None else BlockBudget(spark, max_bad_blocks)
    decode = lambda rows: ingest_audio(rows, "audio_bytes", decoders, budget=budget)
    return land(clips, decode, name, out, corpus, language, quarantine, max_bad, budget=budget)


MANIFEST_COLUMNS = [CLIP_KEY, "shard", "member", "path", "line_block", "line_id", "transcription", "audio_size", "audio_bytes", "error"]


def key_lines(lines: DataFrame) -> DataFrame:
    """Manifest rows with the ``clip_key`` of their member, or of their place if the line is broken."""
    place = F.concat_ws("#", "shard", "line_block", "line_id")
    return lines.withColumn(CLIP_KEY, F.when(F.col("error").isNull(), F.concat_ws("#", "shard", "member")).otherwise(place))


def decode_manifests(
    spark: SparkSession, root: str, lines: DataFrame, decoders=DEFAULT_DECODERS, decode_tasks: int = 0,
    budget: BlockBudget | None = None,
) -> DataFrame:
    """Decoded clips of the labeled manifest lines, one row each, and an ``error`` row for whatever was lost.

    Lost are broken lines, clips that no decoder takes, broken archives and shards without an archive. A task
    decodes the clips of the archive or the range of a plain tar that it reads; with few large compressed archives,
    ``decode_tasks`` spreads the clips first.
    """
    good, broken_lines = split_good_bad(lines)
    labeled = drop_unlabeled(good)
    archives = archive_listing(spark, root)
    clips = join_audio(labeled, read_archives(archives, labeled))
    if decode_tasks:
        clips = clips.repartition(decode_tasks, "shard", "member")
    decoded = ingest_audio(clips, "raw", decoders, budget=budget).withColumn("error", F.coalesce("archive_error", "error"))
    decoded = decoded.withColumn(CLIP_KEY, F.coalesce(CLIP_KEY, "shard"))
    missing = missing_archives(archives, labeled).withColumn(CLIP_KEY, F.col("shard"))
    lost = broken_lines.select(CLIP_KEY, "shard", "member", "error").unionByName(missing)
    return decoded.select(*MANIFEST_COLUMNS).unionByName(lost, allowMissingColumns=True)


def decode_first(
    lines: DataFrame, cap: int, decode: Callable[[DataFrame], DataFrame], stack: ExitStack, budget: BlockBudget | None = None
) -> DataFrame:
    """Decoded clips of the first lines of each shard, until ``cap`` of them could be decoded or its lines end.

    The first ``cap`` labeled lines of every shard are decoded; shards that fell short go on with as many lines as they have
    tried, and so on. A shard whose clips are sound decodes ``cap`` clips however long it is, and one that loses a share
    of them about twice what it needs at most. Each turn is written to the scratch folder, which ``stack`` clears.
    """
    good, broken = split_good_bad(lines)
    numbered = ranked(drop_unlabeled(good), ["shard"], F.col("line_block"), ["line_block", "line_id"], "_line")
    numbered = stack.enter_context(staged(numbered, "numbered"))
    sizes = numbered.groupBy("shard").agg(F.max("_line").alias("_lines"))
    parts, tried = [], cap
    now = numbered.filter(F.col("_line") <= cap).drop("_line").unionByName(broken, allowMissingColumns=True)
    while True:
        rows = decode(now)
        if parts:
            # What the shard as a whole lost was told in the first turn.
            rows = rows.filter(F.col(CLIP_KEY) != F.col("shard"))
        parts.append(stack.enter_context(_watched(rows, budget)))
        decoded = reduce(DataFrame.unionByName, parts)
        enough = decoded.filter("error is null").groupBy("shard").agg(F.count("*").alias("_n")).filter(F.col("_n") >= cap)
        short = sizes.filter(F.col("_lines") > tried).join(enough, "shard", "left_anti").select("shard")
        short = stack.enter_context(staged(short, "short"))
        if short.isEmpty():
            return decoded
        window = numbered.filter((F.col("_line") > tried) & (F.col("_line") <= 2 * tried))
        now = window.join(short, "shard", "left_semi").drop("_line").unionByName(broken.limit(0), allowMissingColumns=True)
        tried *= 2


def name_manifest_rows(good: DataFrame, language: str, corpus: str, split: Column | None, seed: int = SEED) -> DataFrame:
    """Decoded manifest clips in lake schema; without ``split``, splits are carved by a hash of the clip."""
    if split is None:
        good = carve_splits(good, CLIP_KEY, seed=seed)
        split = F.col("split")
    return to_lake_schema(good.withColumn("language", F.lit(language)), split, corpus, [CLIP_KEY])


def ingest_lines(
    spark: SparkSession, root: str, lines: DataFrame, out: str, language: str, corpus: str, split: Column | None = None,
    max_clips_per_shard: int = 0, seed: int = SEED, decoders=DEFAULT_DECODERS, quarantine: str | None = None,
    max_bad: int | None = None, decode_tasks: int = 0, max_bad_blocks: int | None = None,
) -> int:
    """Land the clips of manifest lines; see ``land`` and ``ingest_manifests``."""
    budget = None if max_bad_blocks is None else BlockBudget(spark, max_bad_blocks)

    def decode_all(rows: DataFrame) -> DataFrame:
        decoded = decode_manifests(spark, root, rows, decoders, decode_tasks, budget)
        return decoded.withColumns({"corpus": F.lit(corpus), "language": F.lit(language)})

    def name(good: DataFrame) -> DataFrame:
        capped = cap_per_group(good, ["shard"], ["line_block", "line_id"], F.col("line_block"), max_clips_per_shard)
        return name_manifest_rows(capped, language, corpus, split, seed)

    # The lines are parsed once; they are read for the names, the archives and the join.
    with staged(key_lines(lines), "lines") as parsed, ExitStack() as stack:
        decode = (lambda rows: decode_first(rows, max_clips_per_shard, decode_all, stack, budget)) if max_clips_per_shard else decode_all
        return land(parsed, decode, name, out, corpus, language, quarantine, max_bad, max_clips_per_shard > 0, budget)


def ingest_manifests(
    spark: SparkSession, root: str, out: str, language: str, corpus: str, split: Column | None = None,
    folders: list[str] | None = None, max_shards: int = 0, max_clips_per_shard: int = 0, seed: int = SEED,
    decoders=DEFAULT_DECODERS, quarantine: str | None = None, max_bad: int | None = None, per_folder: bool = False,
    decode_tasks: int = 0, max_bad_blocks: int | None = None,
) -> int:
    """Ingest one source of manifests and archive shards.

    ``split`` is an expression on ``path`` (the manifest file); without it, splits are carved by a hash of the clip.
    ``max_clips_per_shard`` counts decoded clips in manifest order; clips far behind the last of them are not decoded.
    """
    paths: str | list[str] = [f"{root.rstrip('/')}/{f}" for f in folders] if folders else root
    if max_shards:
        paths = [row.path for row in list_shards(spark, root, "manifest_", folders, max_shards, per_folder).collect()]
    return ingest_lines(
        spark, root, read_manifest(spark, paths), out, language, corpus, split, max_clips_per_shard, seed, decoders, quarantine,
        max_bad, decode_tasks, max_bad_blocks,
    )


def ingest_all(spark: SparkSession, sources: dict[str, Callable[[], int]], parallel: int = 1) -> DataFrame:
    """Run every source and report ``(source, ok, rows, error)``; a failed source does not stop the others."""

    def run(item):
        name, job = item
        try:
            return name, True, job(), None
        except Exception as error:  # reported, so that the other sources still land
            return name, False, 0, f"{type(error).__name__}: {error}"

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        outcome = list(pool.map(run, sources.items()))
    return spark.createDataFrame(outcome, "source string, ok boolean, rows bigint, error string")


def ingest_once(spark: SparkSession, out: str, sources: dict[str, Callable[[], int]], parallel: int = 1) -> DataFrame:
    """``ingest_all`` unless the lake already holds data; then every source is reported with 0 new rows."""
    if has_data(spark, out):
        sources = {name: lambda: 0 for name in sources}
    return ingest_all(spark, sources, parallel)


def union_sources(frames: list[DataFrame]) -> DataFrame:
    """Frames in lake schema, whatever their column order, as one."""
    whole = frames[0].select(*LAKE_COLUMNS)
    for frame in frames[1:]:
        whole = whole.unionByName(frame.select(*LAKE_COLUMNS))
    return whole
