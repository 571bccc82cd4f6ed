"""The FITS source: round trips, files made by hand, scaled integers and nulls, blocks of rows, and damaged files."""

import math
import random

import numpy as np
import pytest
from pyspark.errors import PySparkException

from heliotab.sources import fits


@pytest.fixture(scope="module")
def session(spark):
    fits.register(spark)
    return spark


def by_hand(tmp_path, cards, body, name="hand.fits"):
    """A file with an empty first unit and a second one of these cards."""
    data = fits._header([fits.card("SIMPLE", True), fits.card("BITPIX", 8), fits.card("NAXIS", 0)]) + fits._header([fits.card(*c) for c in cards]) + fits._padded(body)
    (tmp_path / name).write_bytes(data)
    return str(tmp_path / name)


def bintable(width, rows, *more, heap=0):
    return [("XTENSION", "BINTABLE"), ("BITPIX", 8), ("NAXIS", 2), ("NAXIS1", width), ("NAXIS2", rows), ("PCOUNT", heap), ("GCOUNT", 1), *more]


def test_cards():
    for value in (True, False, 0, -17, 1.5, -2.25e-300, "text", "it's /not a comment", ""):
        keyword, found, comment = fits.parse_card(fits.card("KEY", value, "why").decode())
        assert (keyword, found, comment) == ("KEY", value, "why")
    assert fits.parse_card("COMMENT  free text / with a slash") == ("COMMENT", None, "free text / with a slash")
    assert fits.parse_card("X       =              1.5D3")[1] == 1500.0
    assert fits.parse_card("X       =                     / nothing")[1] is None
    for bad in ("X       = 'open", "X       = 1.2.3"):
        with pytest.raises(fits.Damaged):
            fits.parse_card(bad)


def test_round_trip_of_all_kinds(session, tmp_path, monkeypatch):
    rows = [(i % 128 - 64, i - 300, -(2**31) + i, 2**63 - 1 - i, i / 7, float(i) if i % 5 else None, None if i % 3 else i, bool(i % 2) if i % 4 else None, "é" * (i % 6), [1.5 * j for j in range(i % 4)]) for i in range(600)]
    df = session.createDataFrame(rows, "b byte, s short, i int, l long, d double, f float, n int, t boolean, a string, v array<double>").repartition(3)
    path = str(tmp_path / "table")
    df.write.format("fits").mode("append").save(path)
    back = session.read.format("fits").option("nan_is_null", "true").load(path)
    assert back.schema == df.schema
    assert sorted(map(repr, back.collect())) == sorted(map(repr, df.collect()))
    some = session.read.format("fits").schema("a string, l long").load(path)
    assert sorted(map(tuple, some.collect())) == sorted((r[8], r[3]) for r in rows)
    df.limit(5).write.format("fits").mode("overwrite").save(path)
    assert session.read.format("fits").load(path).count() == 5
    assert all(r["stated"] == r["found"] for r in fits.checksums(session, path).collect())


def test_nothing_is_one_file(session, tmp_path):
    path = str(tmp_path / "none")
    session.createDataFrame([], "a int, b string, v array<double>").write.format("fits").mode("append").save(path)
    back = session.read.format("fits").load(path)
    assert back.columns == ["a", "b", "v"] and back.count() == 0


def test_scaled_integers_nulls_bits_and_complex(session, tmp_path):
    raw = np.array([(0, 5, -32768, 0b10100000, 1.5, 2.5, b"T"), (255, -99, 32767, 0b01000000, -1.0, 0.0, b"F"), (3, 7, 0, 0b11100000, math.nan, 0.0, b"\0")], dtype=[("u", ">u1"), ("i", ">i2"), ("w", ">i2"), ("x", ">u1"), ("re", ">f4"), ("im", ">f4"), ("l", "S1")])
    cards = bintable(raw.dtype.itemsize, 3, ("TFIELDS", 6), ("TTYPE1", "u"), ("TFORM1", "B"), ("TNULL1", 255), ("TTYPE2", "i"), ("TFORM2", "1I"), ("TSCAL2", 0.5), ("TZERO2", 10.0), ("TNULL2", -99), ("TTYPE3", "w"), ("TFORM3", "I"), ("TZERO3", 32768.0), ("TTYPE4", "x"), ("TFORM4", "3X"), ("TTYPE5", "c"), ("TFORM5", "C"), ("TTYPE6", "l"), ("TFORM6", "L"))
    got = session.read.format("fits").load(by_hand(tmp_path, cards, raw.tobytes())).collect()
    assert [r["u"] for r in got] == [0, None, 3] and [r["i"] for r in got] == [12.5, None, 13.5]
    assert [r["w"] for r in got] == [0, 65535, 32768] and [r["x"] for r in got] == [[True, False, True], [False, True, False], [True, True, True]]
    assert [r["c"] for r in got][:2] == [[1.5, 2.5], [-1.0, 0.0]] and [r["l"] for r in got] == [True, False, None]


def test_arrays_in_rows_and_behind_them(session, tmp_path):
    rows = b"".join(np.array(v, dtype=">i4").tobytes() + np.array(p, dtype=">i4").tobytes() for v, p in (((1, 2), (3, 0)), ((3, 4), (0, 12)), ((5, 6), (1, 12))))
    heap = np.array([7, 8, 9, 10], dtype=">i4").tobytes()
    cards = bintable(16, 3, ("TFIELDS", 2), ("TTYPE1", "pair"), ("TFORM1", "2J"), ("TTYPE2", "many"), ("TFORM2", "1PJ(3)"), heap=16)
    got = session.read.format("fits").load(by_hand(tmp_path, cards, rows + heap)).collect()
    assert [(r["pair"], r["many"]) for r in got] == [([1, 2], [7, 8, 9]), ([3, 4], []), ([5, 6], [10])]


def test_images_by_blocks(session, tmp_path, monkeypatch):
    values = np.arange(60, dtype=">i2").reshape(3, 4, 5)
    cards = [("XTENSION", "IMAGE"), ("BITPIX", 16), ("NAXIS", 3), ("NAXIS1", 5), ("NAXIS2", 4), ("NAXIS3", 3), ("PCOUNT", 0), ("GCOUNT", 1), ("BSCALE", 2.0), ("BZERO", -1.0), ("BLANK", 7)]
    path = by_hand(tmp_path, cards, values.tobytes())
    monkeypatch.setattr(fits, "PART", 30)
    got = session.read.format("fits").option("kind", "image").load(path).collect()
    want = {(x, y, z): None if values[z, y, x] == 7 else 2.0 * values[z, y, x] - 1 for x in range(5) for y in range(4) for z in range(3)}
    assert {(r["x"], r["y"], r["z"]): r["v"] for r in got} == want and len(got) == 60
    reader = fits.FitsSource({"path": path, "kind": "image"})
    assert [(p.first, p.count) for p in reader.reader(reader.schema()).partitions()] == [(i, 3) for i in range(0, 12, 3)]


def test_image_round_trip(session, tmp_path):
    r = random.Random(3)
    pixels = {(k, r.randrange(9), r.randrange(7)): r.random() for k in ("a", "b") for _ in range(40)}
    df = session.createDataFrame([(*p, v) for p, v in pixels.items()], "image string, x int, y int, v double")
    fits.write_images(df, str(tmp_path / "images"), "image", 9, 7)
    for k in ("a", "b"):
        got = session.read.format("fits").option("kind", "image").load(str(tmp_path / f"images/image-{k}.fits")).collect()
        assert len(got) == 63 and {(k, x["x"], x["y"]): x["v"] for x in got if not math.isnan(x["v"])} == {p: v for p, v in pixels.items() if p[0] == k}


def test_headers_and_named_units(session, tmp_path):
    raw = np.array([1, 2], dtype=">i4").tobytes()
    path = by_hand(tmp_path, bintable(4, 2, ("TFIELDS", 1), ("TTYPE1", "a"), ("TFORM1", "J"), ("EXTNAME", "ONE"), ("NOTE", "it's")), raw)
    cards = {(r["unit"], r["keyword"]): r["value"] for r in session.read.format("fits").option("kind", "header").load(path).collect()}
    assert cards[1, "EXTNAME"] == "ONE" and cards[1, "NOTE"] == "it's" and cards[0, "SIMPLE"] == "True"
    assert session.read.format("fits").option("unit", "ONE").load(path).count() == 2 == session.read.format("fits").option("unit", "1").load(path).count()
    with pytest.raises(PySparkException, match="no table"):
        session.read.format("fits").option("unit", "TWO").load(path).count()


@pytest.mark.parametrize("hurt", ["cut", "cards", "end", "axes", "form", "text"])
def test_damaged_files_are_refused(session, tmp_path, hurt):
    raw = np.arange(2000, dtype=">i4").tobytes()
    cards = bintable(4, 2000, ("TFIELDS", 1), ("TTYPE1", "a"), ("TFORM1", "J"))
    path = by_hand(tmp_path, cards, raw)
    data = bytearray((tmp_path / "hand.fits").read_bytes())
    if hurt == "cut":
        data = data[:-2880]
    elif hurt == "cards":
        data[0:6] = b"SAMPLE"
    elif hurt == "end":
        at = data.index(b"END     ", 2880)
        data[at : at + 3] = b"   "
        data = data[: at // 2880 * 2880 + 2880]
    elif hurt == "axes":
        data = data.replace(b"NAXIS1  =                    4", b"NAXIS1  =                   -4")
    elif hurt == "form":
        data = data.replace(b"'J       '", b"'W       '")
    else:
        data[2880 + 100] = 200
    (tmp_path / "hand.fits").write_bytes(bytes(data))
    with pytest.raises(PySparkException):
        session.read.format("fits").load(path).count()


def test_texts_that_would_change_are_refused(session, tmp_path):
    with pytest.raises(PySparkException):
        session.createDataFrame([("blank ",)], "a string").write.format("fits").mode("append").save(str(tmp_path / "x"))
    assert not list((tmp_path / "x").glob("*.fits")) if (tmp_path / "x").exists() else True
