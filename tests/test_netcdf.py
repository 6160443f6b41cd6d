import struct

import numpy as np
import pytest

from basinflow.sources import netcdf as N

NUMBER = {np.dtype(t): n for n, t in N.TYPES.items()}


def classic(version, dims, variables, records):
    """A file's bytes: dims by name (0: records), variables by name as (dims, array, attributes)."""
    size, offset = (">q" if version == 5 else ">i"), (">i" if version == 1 else ">q")
    pad = lambda b: b + b"\0" * (-len(b) % 4)
    count = lambda n: struct.pack(size, n)
    name = lambda s: count(len(s)) + pad(s.encode())

    def attribute(value):
        if isinstance(value, str):
            return struct.pack(">i", 2) + count(len(value)) + pad(value.encode())
        return struct.pack(">i", NUMBER[value.dtype]) + count(1) + pad(value.tobytes())

    def listed(tag, parts):
        return struct.pack(">i", tag if parts else 0) + count(len(parts)) + b"".join(parts)

    names = list(dims)
    begins = dict.fromkeys(variables, 0)
    own = [k for k, (d, _, _) in variables.items() if dims[d[0]] == 0]
    step = lambda k: variables[k][1][:1].tobytes() if len(own) == 1 else pad(variables[k][1][:1].tobytes())
    for _ in range(2):  # the first round gives the header's size
        parts = []
        for k, (d, a, atts) in variables.items():
            parts.append(name(k) + count(len(d)) + b"".join(count(names.index(x)) for x in d) + listed(12, [name(n) + attribute(v) for n, v in atts.items()]) + struct.pack(">i", NUMBER[a.dtype]) + count(0) + struct.pack(offset, begins[k]))
        head = b"CDF" + bytes([version]) + count(records) + listed(10, [name(n) + count(v) for n, v in dims.items()]) + listed(12, [name("title") + attribute("x")]) + listed(11, parts)
        at = len(head)
        for k, (d, a, _) in variables.items():
            if k not in own:
                begins[k], at = at, at + len(pad(a.tobytes()))
        for k in own:
            begins[k], at = at, at + len(step(k))
    body = b"".join(pad(a.tobytes()) for k, (_, a, _) in variables.items() if k not in own)
    cut = (lambda b: b) if len(own) == 1 else pad
    return head + body + b"".join(cut(variables[k][1][r : r + 1].tobytes()) for r in range(records) for k in own)


@pytest.mark.parametrize("version", [1, 2, 5])
@pytest.mark.parametrize("record", [True, False])
def test_values_times_and_missing(spark, tmp_path, version, record):
    rain = np.arange(2 * 3 * 2 * 3, dtype=">i2").reshape(2, 3, 2, 3)
    rain[0, 0, 0, 0] = -99
    time = np.array([0, 31], ">f8")
    atts = {"_FillValue": np.array([-99], ">i2"), "scale_factor": np.array([0.5], ">f4"), "add_offset": np.array([10.0], ">f8")}
    dims = {"time": 0 if record else 2, "ensemble": 3, "north_south": 2, "east_west": 3}
    data = classic(version, dims, {"north_south": (["north_south"], np.array([1.0, 2.0], ">f4"), {}), "time": (["time"], time, {"units": "days since 2026-03-31"}), "Rainf_tavg": (list(dims), rain, atts)}, 2 if record else 0)
    (tmp_path / "a.nc").write_bytes(data)
    rows = {(r.time.month, r.ensemble, r.lat_idx, r.lon_idx): r for r in N.read_classic(spark, str(tmp_path / "a.nc"), "Rainf_tavg").collect()}
    assert len(rows) == 36 and rows[3, 0, 0, 0].value is None and rows[3, 0, 0, 1].profile is None
    for (m, e, i, j), r in rows.items():
        if (m, e, i, j) != (3, 0, 0, 0):
            assert r.value == 10 + 0.5 * rain[{3: 0, 5: 1}[m], e, i, j]


def test_one_record_variable_alone_is_not_padded():
    values = np.arange(6, dtype=">i2").reshape(2, 3)
    file = N.Classic(classic(1, {"time": 0, "x": 3}, {"v": (["time", "x"], values, {})}, 2))
    assert [s.tolist() for s in file.steps("v")] == [[0, 1, 2], [3, 4, 5]]


def test_wrong_files_and_variables(spark, tmp_path):
    with pytest.raises(ValueError):
        N.Classic(b"\x89HDF....")
    (tmp_path / "b.nc").write_bytes(classic(1, {"time": 2}, {"time": (["time"], np.array([0, 1], ">f8"), {"units": "days since 2026-01-01"})}, 0))
    with pytest.raises(Exception, match="is not in"):
        N.read_classic(spark, str(tmp_path / "b.nc"), "Qs_tavg").collect()
