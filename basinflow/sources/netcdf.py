"""NetCDF classic files (formats 1, 2 and 5) as long tables, without further libraries.

Spark reads each file, so any store will do; a file is decoded by one task, a time step at a time.
Files of format 4 are HDF5 and need xarray (see :func:`basinflow.sources.arrays.read_rasters`).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from basinflow.grid import clean, find_coordinate, find_profile
from basinflow.sources.zarr import decoded_times

#: The types of the format by their numbers, and the tags of its lists.
TYPES = {1: "i1", 2: "S1", 3: ">i2", 4: ">i4", 5: ">f4", 6: ">f8", 7: "u1", 8: ">u2", 9: ">u4", 10: ">i8", 11: ">u8"}
DIMENSIONS, VARIABLES, ATTRIBUTES = 10, 11, 12


@dataclass
class Variable:
    dims: list[str]
    shape: list[int]
    kind: np.dtype
    begin: int
    is_record: bool
    attributes: dict = field(default_factory=dict)

    @property
    def step_bytes(self) -> int:
        """Bytes of one record, or of all of a variable without records."""
        return math.prod(self.shape[1:] if self.is_record else self.shape) * self.kind.itemsize


class Classic:
    """The header of a file, and the values of its variables."""

    def __init__(self, data: bytes) -> None:
        if data[:3] != b"CDF" or data[3] not in (1, 2, 5):
            raise ValueError("not a NetCDF classic file")
        self.data, self.at = data, 4
        self.count, self.offset = (8 if data[3] == 5 else 4), (4 if data[3] == 1 else 8)
        self.records = self.integer(self.count)
        sizes = self.listed(DIMENSIONS, lambda: self.integer(self.count))
        names = list(sizes)
        self.attributes = self.listed(ATTRIBUTES, self.attribute)
        self.variables: dict[str, Variable] = self.listed(VARIABLES, lambda: self.variable(names, sizes))
        own = [v for v in self.variables.values() if v.is_record]
        # one record variable alone is not padded
        self.record_bytes = own[0].step_bytes if len(own) == 1 else sum(-(-v.step_bytes // 4) * 4 for v in own)

    def integer(self, size: int) -> int:
        self.at += size
        return int.from_bytes(self.data[self.at - size : self.at], "big")

    def padded(self, size: int) -> bytes:
        start = self.at
        self.at += -(-size // 4) * 4
        return self.data[start : start + size]

    def name(self) -> str:
        return self.padded(self.integer(self.count)).decode()

    def listed(self, tag: int, read) -> dict:
        found, size = self.integer(4), self.integer(self.count)
        if found not in (0, tag):
            raise ValueError(f"list {tag} expected, {found} found")
        return {self.name(): read() for _ in range(size)}

    def attribute(self):
        kind = np.dtype(TYPES[self.integer(4)])
        raw = self.padded(self.integer(self.count) * kind.itemsize)
        return raw.decode().rstrip("\0") if kind == "S1" else np.frombuffer(raw, kind)

    def variable(self, names: list[str], sizes: dict[str, int]) -> Variable:
        dims = [names[self.integer(self.count)] for _ in range(self.integer(self.count))]
        attributes, kind = self.listed(ATTRIBUTES, self.attribute), np.dtype(TYPES[self.integer(4)])
        self.integer(self.count)  # the size, which follows from the shape
        is_record = bool(dims) and sizes[dims[0]] == 0
        shape = [self.records if i == 0 and is_record else sizes[d] for i, d in enumerate(dims)]
        return Variable(dims, shape, kind, self.integer(self.offset), is_record, attributes)

    def steps(self, name: str) -> Iterator[np.ndarray]:
        """The values along the first dimension, one index at a time; missing values as NaN, scaled."""
        v = self.variables[name]
        rest = v.shape[1:]
        size = math.prod(rest)
        for i in range(v.shape[0]):
            start = v.begin + i * (self.record_bytes if v.is_record else size * v.kind.itemsize)
            raw = np.frombuffer(self.data, v.kind, size, start).astype(float).reshape(rest)
            for missing in ("_FillValue", "missing_value"):
                if missing in v.attributes:
                    raw[raw == float(v.attributes[missing][0])] = np.nan
            yield raw * float(v.attributes.get("scale_factor", [1.0])[0]) + float(v.attributes.get("add_offset", [0.0])[0])

    def times(self, name: str) -> list:
        """The moments of a time coordinate, from its units; KeyError without them."""
        return decoded_times([float(x) for x in self.steps(name)], self.variables[name].attributes["units"])


def step_rows(file: Classic, variable: str, path: str) -> Iterator[pd.DataFrame]:
    v = file.variables.get(variable)
    if v is None:
        raise KeyError(f"{variable} is not in {path}: {sorted(file.variables)}")
    lat, lon, time, depth = *(find_coordinate(v.dims, k) for k in ("lat", "lon", "time")), find_profile(v.dims)
    if v.dims[0] != time:
        raise ValueError(f"the first dimension of {variable} is {v.dims[0]}, not {time}")
    for moment, values in zip(file.times(time), file.steps(variable)):
        index = dict(zip(v.dims[1:], np.indices(values.shape)))
        column = lambda d: pd.array([None] * values.size, "Int32") if d not in index else index[d].ravel().astype(np.int32)
        yield pd.DataFrame({"path": path, "time": pd.Timestamp(moment), "ensemble": column("ensemble"), "profile": column(depth), "lat_idx": column(lat), "lon_idx": column(lon), "value": values.ravel()})


def read_classic(spark: SparkSession, paths: list[str] | str, variable: str) -> DataFrame:
    """One variable of NetCDF classic files as a long grid (path, time, ensemble, profile, lat_idx, lon_idx, value).

    Ensemble and depth are indices, NULL where the variable lacks them.  A file without the variable raises KeyError.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path, content in zip(b["path"], b["content"]):
                yield from step_rows(Classic(content), variable, path)

    files = spark.read.format("binaryFile").load(paths).select("path", "content")
    return clean(files.mapInPandas(run, "path string, time timestamp, ensemble int, profile int, lat_idx int, lon_idx int, value double"))
