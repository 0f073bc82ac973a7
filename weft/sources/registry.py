"""Named datasets (S1): from a registry entry to an aligned DataFrame.

The registry is small driver-side configuration; data is only read by Spark.
An entry names one place (a hub repository, a loading script or a file) and
may rename the columns that hold prompt, query, response and history.
"""

from __future__ import annotations

import json
import os
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from weft.operators.align import align, concat_aligned
from weft.operators.split import first_n
from weft.sources.readers import scan

# Keys of a registry entry (fixed values), in order of precedence.
PLACES = {"hf_hub_url": "hub", "script_url": "script", "file_name": "file"}
# Columns of an entry that renames none (fixed values).
USUAL_COLUMNS = {"prompt": "instruction", "query": "input", "response": "output", "history": None}


@dataclass(frozen=True)
class Source:
    """Where one dataset lies and which of its columns play which role."""

    kind: str
    place: str
    columns: Mapping[str, str | None]
    prefix: str | None = None
    checksum: str | None = None

    @classmethod
    def from_entry(cls, name: str, entry: Mapping, prefix: str | None) -> Source:
        key = next((k for k in PLACES if k in entry), None)
        if key is None:
            raise ValueError(f"dataset {name!r} names none of {', '.join(PLACES)}")
        renamed = entry.get("columns")
        columns = USUAL_COLUMNS if renamed is None else {role: renamed.get(role) for role in USUAL_COLUMNS}
        return cls(PLACES[key], entry[key], columns, prefix, entry.get("file_sha1") if key == "file_name" else None)

    def read(self, spark: SparkSession, base_dir: str) -> DataFrame:
        if self.kind != "file":
            raise NotImplementedError(f"{self.place}: a {self.kind} source needs the network")
        return scan(spark, os.path.join(base_dir, self.place))


def load_registry(path_or_dict: str | Mapping) -> Mapping:
    if isinstance(path_or_dict, Mapping):
        return path_or_dict
    with open(path_or_dict, encoding="utf-8") as f:
        return json.load(f)


def sources(names: str, registry: Mapping, prefixes: str | None = None) -> list[Source]:
    """The sources of comma-separated ``names``.  ``prefixes`` are
    separated by ``|``: one for all, or one for each name."""
    wanted = [n.strip() for n in names.split(",")]
    missing = [n for n in wanted if n not in registry]
    if missing:
        raise ValueError(f"not in the registry: {', '.join(missing)}")
    given: list[str | None] = list(prefixes.split("|")) if prefixes is not None else [None]
    if len(given) not in (1, len(wanted)):
        raise ValueError(f"{len(given)} prefixes for {len(wanted)} datasets: give one, or one for each")
    each = given * len(wanted) if len(given) == 1 else given
    return [Source.from_entry(n, registry[n], p) for n, p in zip(wanted, each)]


def load_datasets(spark: SparkSession, names: str, registry: str | Mapping, base_dir: str, prefixes: str | None = None,
                  max_samples: int | None = None, order: list[str] | None = None) -> DataFrame:
    """Scan each source (S2), keep its first ``max_samples`` rows by ``order``
    (L1; rows of a distributed table have no order of their own, so a limit
    needs one), align (P1) and concatenate (U1)."""
    if max_samples is not None and not order:
        raise ValueError("max_samples needs an order")
    parts = []
    for s in sources(names, load_registry(registry), prefixes):
        rows = first_n(s.read(spark, base_dir), max_samples, order or [])
        parts.append(align(rows, *(s.columns[role] for role in USUAL_COLUMNS), prefix=s.prefix or ""))
    return concat_aligned(parts)
