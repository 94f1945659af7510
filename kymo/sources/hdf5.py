"""HDF5 recordings as a Python data source: one partition per file, one row per window or recording.

``spark.dataSource.register(RecordingSource)`` then
``spark.read.format("recordings").load(folder)``.  ``h5py`` is imported in the
reader only, so the rest works without it.  Rows that break the metadata
contract carry a ``reject_reason`` instead of being lost.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "sample_name string, h5_file string, window_index int, window_label int, target int, frequency int, ppg_config int, ppg array<array<double>>, acc array<array<double>>, reject_reason string"
#: Fixed values of the contract.
FREQUENCIES, CONFIGS = (25, 100), (0, 1, 2)
_WINDOW = re.compile(r"w(\d+)_(\d+)$")


def parse_window_name(name: str) -> tuple[int, int] | None:
    """(index, label) of a child group named ``..w<index>_<label>``."""
    m = _WINDOW.search(name)
    return (int(m[1]), int(m[2])) if m else None


def reject_reason(frequency: int | None, config: int | None) -> str | None:
    if frequency is None:
        return "missing_frequency"
    if frequency not in FREQUENCIES:
        return "invalid_frequency"
    if config is None:
        return "missing_ppg_config"
    return None if config in CONFIGS else "invalid_ppg_config"


class RecordingSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "recordings"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return RecordingReader(self.options["path"])


class RecordingReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[InputPartition]:
        import glob

        return [InputPartition(f) for f in sorted(glob.glob(f"{self.path}/*.h5"))]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        import h5py

        def scalar(*groups, field: str):
            return next((int(g[field][()]) for g in groups if field in g), None)

        def channels(group, field: str):
            return group[field][()].astype(float).tolist() if field in group else None

        try:
            with h5py.File(partition.value, "r") as f:
                for name, record in f.items():
                    windows = sorted((parse_window_name(k), g) for k, g in record.items() if parse_window_name(k))
                    for (index, label), g in windows or [((None, None), record)]:
                        frequency, config = scalar(g, record, field="frequency"), scalar(g, record, field="ppg_config")
                        yield name, partition.value, index, label, scalar(g, record, field="target"), frequency, config, channels(g, "ppg"), channels(g, "acc"), reject_reason(frequency, config)
        except OSError as e:
            yield None, partition.value, None, None, None, None, None, None, None, f"unreadable: {e}"
