import gzip
import json
import zlib

import numpy as np
import pytest
import zstandard

from basinflow.sources import zarr as Z


def store(root, name, values, chunks, dims, compressor, encode, skip=(), **attributes):
    base = root / name
    base.mkdir(parents=True)
    (base / ".zarray").write_text(json.dumps({"shape": values.shape, "chunks": chunks, "dtype": values.dtype.str, "compressor": compressor, "fill_value": -9.0, "order": "C", "filters": None, "zarr_format": 2}))
    (base / ".zattrs").write_text(json.dumps({"_ARRAY_DIMENSIONS": dims} | attributes))
    for key in np.ndindex(*[-(-n // c) for n, c in zip(values.shape, chunks)]):
        if key in skip:
            continue
        block = np.full(chunks, -9.0, values.dtype)
        part = values[tuple(slice(k * c, (k + 1) * c) for k, c in zip(key, chunks))]
        block[tuple(slice(0, n) for n in part.shape)] = part
        (base / ".".join(map(str, key))).write_bytes(encode(block.tobytes()))


@pytest.mark.parametrize("compressor,encode", [(None, bytes), ({"id": "zlib", "level": 1}, zlib.compress), ({"id": "gzip", "level": 1}, gzip.compress), ({"id": "zstd", "level": 1}, zstandard.ZstdCompressor().compress)])
def test_chunks_are_read_whole(spark, tmp_path, compressor, encode):
    values = np.arange(2 * 5 * 3, dtype="<f4").reshape(2, 5, 3)
    values[0, 0, 0], values[1, 4, 2] = np.nan, -9.0
    store(tmp_path, "Qs", values, [1, 2, 2], ["time", "lat", "lon"], compressor, encode, skip=[(0, 2, 1)])
    store(tmp_path, "time", np.array([0.0, 30.0]), [2], ["time"], compressor, encode, units="days since 2026-04-01")
    rows = {(r.time.month, r.lat_idx, r.lon_idx): r.value for r in Z.read_variable(spark, str(tmp_path), "Qs").collect()}
    assert len(rows) == 2 * 5 * 3 - 1 and (4, 4, 2) not in rows  # its chunk is not stored
    assert rows[4, 0, 0] is None and rows[5, 4, 2] is None
    assert rows[4, 1, 2] == 5.0 and rows[4, 4, 1] == 13.0 and rows[5, 0, 0] == 15.0


def test_missing_arrays_and_coordinates(spark, tmp_path):
    with pytest.raises(KeyError):
        Z.array_meta(spark, str(tmp_path / "none"))
    store(tmp_path, "lat", np.array([-20.0, -19.5, -19.0]), [2], ["lat"], None, bytes)
    assert [r.coord for r in Z.read_coordinate(spark, str(tmp_path / "lat")).orderBy("idx").collect()] == [-20.0, -19.5, -19.0]
    assert Z.decoded_times([24], "hours since 2026-01-01T00:00:00")[0].day == 2


def test_several_stores_are_one_grid(spark, tmp_path):
    for number, start in enumerate((0.0, 30.0)):
        store(tmp_path / str(number), "Qs", np.full((1, 2, 2), float(number + 1)), [1, 2, 2], ["time", "lat", "lon"], None, bytes)
        store(tmp_path / str(number), "time", np.array([start]), [1], ["time"], None, bytes, units="days since 2026-04-01")
    rows = Z.read_stores(spark, [str(tmp_path / "0"), str(tmp_path / "1")], "Qs").collect()
    assert sorted((r.time.month, r.value) for r in rows) == [(4, 1.0)] * 4 + [(5, 2.0)] * 4
    with pytest.raises(KeyError):
        Z.read_stores(spark, [str(tmp_path / "0"), str(tmp_path / "none")], "Qs")
