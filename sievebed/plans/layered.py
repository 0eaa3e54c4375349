"""Config-driven run of datasets through the raw, cleaned and curated layers."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from sievebed.fixed_values import DATASETS, DATASETS_AT_ONCE
from sievebed.plans.cleaning import clean_layer, curate_layer
from sievebed.plans.ingest import ingest_layer


@dataclass(frozen=True)
class DatasetSpec:
    """What one dataset asks for and how it is cleaned."""

    folder: str
    url: str
    id_column: str
    suffix: str = ""
    cleaning: str = "default"
    schema: StructType | str | None = None
    outer: bool = False
    years: tuple[str, ...] = ()


def standard_specs(site: str, schemas: Mapping[str, StructType | str] | None = None) -> list[DatasetSpec]:
    """The seven datasets, under the given site.

    ``schemas`` has document schemas by folder.  The sites do not publish theirs; a dataset without one
    is inferred, which reads its raw layer twice.
    """
    base, known = site.rstrip("/"), schemas or {}
    return [
        DatasetSpec(folder, f"{base}/{endpoint}", id_column, suffix, cleaning, known.get(folder))
        for folder, endpoint, id_column, suffix, cleaning in DATASETS
    ]


def run_dataset(
    spark: SparkSession,
    spec: DatasetSpec,
    keys: DataFrame,
    responses: DataFrame,
    root: str,
    curated_options: Callable[[str], dict[str, str]] | None = None,
    curated_format: str = "parquet",
    order_by: str | None = None,
    on_error: str = "raise",
    latest_by: str | None = None,
) -> str:
    """Raw, cleaned and curated layer of one dataset, each read back from the one before.

    ``on_error`` holds for responses and documents alike; documents set aside go to ``bad``.
    """
    raw, cleaned = f"{root}/raw/{spec.folder}", f"{root}/cleaned/{spec.folder}"
    options = curated_options(spec.folder) if curated_options else {"path": f"{root}/curated/{spec.folder}"}
    ingest_layer(keys, responses, raw, spec.url, spec.id_column, spec.suffix, order_by, on_error, latest_by)
    bad = f"{root}/bad/{spec.folder}" if on_error == "quarantine" else None
    clean_layer(
        spark, raw, cleaned, spec.cleaning, spec.schema, on_error=on_error, bad_path=bad, outer=spec.outer,
        years=list(spec.years) or None,
    )
    curate_layer(spark, cleaned, options, curated_format)
    return options.get("path", spec.folder)


def run_layers(
    spark: SparkSession,
    specs: Iterable[DatasetSpec],
    keys: DataFrame,
    responses: Callable[[str], DataFrame],
    root: str,
    at_once: int = DATASETS_AT_ONCE,
    **settings,
) -> dict[str, str]:
    """All datasets, a few at once so that small ones share the cluster: folder -> curated path.

    ``responses(folder)`` gives a dataset's stored responses, so that each reads only its own.  The
    first failing dataset fails the run.
    """
    specs = list(specs)

    @inheritable_thread_target(spark)
    def job(spec: DatasetSpec) -> str:
        return run_dataset(spark, spec, keys, responses(spec.folder), root, **settings)

    with ThreadPoolExecutor(max_workers=at_once) as pool:
        return dict(zip((spec.folder for spec in specs), pool.map(job, specs), strict=True))
