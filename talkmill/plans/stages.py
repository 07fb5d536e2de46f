"""The stages of a recording's processing: which run, where, and what each is checked by."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Stage:
    name: str
    place: str
    outputs: tuple[tuple[str, str | None], ...]


#: In order; outputs are (artifact, reference) with None where there is no reference.
STAGES = (
    Stage("sync", "cpu", (("screen_sync", "camera"), ("camera_sync", None))),
    Stage("transcription", "gpu", (("transcript_classified", None),)),
    Stage("audio", "cpu", (("camera_muted", "camera"),)),
    Stage("face_anon", "gpu", (("camera_anon", "camera_muted"),)),
    Stage("track_instructor", "gpu", (("camera_tracked", "camera_anon"),)),
    Stage("cards", "local", (("screen_with_cards", "screen_sync"),)),
    Stage("captions", "cpu", (("captions", None),)),
    Stage("assembly", "cpu", (("final", "camera_anon"), ("final_camera_only", "camera_anon"))),
)
#: Outputs that are checked only where they exist.
OPTIONAL = ("camera_sync", "final_camera_only")
#: Limits that differ from the usual ones, by artifact.
OVERRIDES = {"screen_sync": {"tol_s": 5.0}, "camera_tracked": {"size_lo": 0.02}}
#: Outputs that must carry sound.
WITH_AUDIO = ("camera_sync", "camera_muted", "camera_anon", "camera_tracked", "final", "final_camera_only")
#: Which artifact a consumer takes: the first of these that exists, else the last.
CHOICES = {
    "camera": ("camera_sync", "camera"),
    "pip_camera": ("camera_tracked", "camera_anon", "camera_muted"),
    "assembly_camera": ("camera_anon", "camera_muted"),
    "transcript": ("transcript_classified", "transcript_legacy"),
}


def selected(first: str | None = None, last: str | None = None, only: str | None = None, skip: tuple[str, ...] = ()) -> list[Stage]:
    """The stages from first to last, or only one, without those skipped."""
    names = [s.name for s in STAGES]
    for name in (first, last, only, *skip):
        if name is not None and name not in names:
            raise ValueError(f"no stage {name!r}")
    low, high = (names.index(only),) * 2 if only else (names.index(first) if first else 0, names.index(last) if last else len(names) - 1)
    if high < low:
        raise ValueError(f"{first} comes after {last}")
    return [s for s in STAGES[low : high + 1] if s.name not in skip]


def placed(stages: list[Stage], on_cluster: bool, force: bool = False) -> list[Stage]:
    """stages, if they may run here: local ones are refused on a cluster unless forced."""
    bad = [s.name for s in stages if s.place == "local" and on_cluster]
    if bad and not force:
        raise ValueError(f"{', '.join(bad)} may not run on the cluster")
    return stages


def checks(spark: SparkSession) -> DataFrame:
    """(stage, position, artifact, reference, optional, expect_audio, tol_s, size_lo): what each stage's outputs are checked by."""
    rows = [(s.name, i, a, ref, a in OPTIONAL, a in WITH_AUDIO, OVERRIDES.get(a, {}).get("tol_s"), OVERRIDES.get(a, {}).get("size_lo")) for i, s in enumerate(STAGES) for a, ref in s.outputs]
    return spark.createDataFrame(rows, "stage string, position int, artifact string, reference string, optional boolean, expect_audio boolean, tol_s double, size_lo double")


def choices(spark: SparkSession) -> DataFrame:
    """(want, candidate, priority, is_default)."""
    rows = [(want, c, i, i == len(cs) - 1) for want, cs in CHOICES.items() for i, c in enumerate(cs)]
    return spark.createDataFrame(rows, "want string, candidate string, priority int, is_default boolean")


def sweep(media: DataFrame, key: str, checked: DataFrame) -> DataFrame:
    """(key, stage, artifact, problems) of every recording's stages that have an output at all.

    media has a row for each artifact of a recording: path_exists, size, duration and so on.
    """
    facts = F.struct(*[c for c in media.columns if c != key])
    return sweep_lists(media.groupBy(key).agg(F.collect_list(facts).alias("artifacts")), key, checked)


def sweep_lists(recordings: DataFrame, key: str, checked: DataFrame) -> DataFrame:
    """sweep() of recordings (key, artifacts) that hold their artifacts' rows as a list.

    References and the outputs of a stage are looked up in the recording's own list, so
    recordings are joined with nothing but the checks.
    """
    from ..operators.media import problems

    c = F.col
    outputs = checked.groupBy("stage").agg(F.collect_list("artifact").alias("__outputs"))
    rules = checked.join(F.broadcast(outputs), "stage")
    # generators, so that a list is not made again for each of its uses below
    lists = recordings.filter(c(key).isNotNull()).select(key, F.explode(F.array("artifacts")).alias("__all"))
    begun = F.transform(F.filter("__all", lambda a: a["path_exists"]), lambda a: a["artifact"])
    rows = lists.select(key, "__all", F.explode(F.array(begun)).alias("__begun")).select(key, "__all", "__begun", F.inline("__all"))
    rows = rows.join(F.broadcast(rules), "artifact").filter("(path_exists or not optional) and arrays_overlap(__begun, __outputs)")
    refs = F.when(c("reference").isNotNull(), F.filter("__all", lambda a: a["artifact"] == c("reference")))
    rows = rows.withColumn("__refs", refs).drop("__all", "__begun", "__outputs")
    due = rows.select("*", F.explode_outer("__refs").alias("__ref")).drop("__refs")
    due = due.withColumns({"wants_ref": c("reference").isNotNull(), "ref_size": F.when(c("__ref.path_exists"), c("__ref.size")), "ref_duration": c("__ref.duration")})
    return due.select(key, "stage", "artifact", problems(due).alias("problems"))


def verdicts(swept: DataFrame, key: str, strict: bool = False) -> DataFrame:
    """(key, stage, n_problems); strict makes a stage with problems an error when it is read."""
    totals = swept.groupBy(key, "stage").agg(F.sum(F.size("problems")).alias("n_problems"))
    if not strict:
        return totals
    fail = F.raise_error(F.concat(F.lit("stage "), F.col("stage"), F.lit(" has problems"))).cast("long")
    return totals.withColumn("n_problems", F.when(F.col("n_problems") > 0, fail).otherwise(F.col("n_problems")))
