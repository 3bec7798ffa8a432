import itertools
import json
import tracemalloc
import zipfile

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pixsieve import schema as S
from pixsieve import sources
from pixsieve.sources.zipped import array_items


def pieces(data: bytes, size: int):
    return (data[i:i + size] for i in range(0, len(data), size))


def items(data: bytes, size: int = 7):
    return [value for value, _ in array_items(pieces(data, size))]


VALUES = st.recursive(
    st.none() | st.booleans() | st.integers(-10**20, 10**20) | st.floats(allow_nan=False, allow_infinity=False) | st.text(max_size=12),
    lambda inner: st.lists(inner, max_size=4) | st.dictionaries(st.text(max_size=5), inner, max_size=4), max_leaves=12,
)


@settings(max_examples=200, deadline=None)
@given(st.lists(VALUES, max_size=6), st.integers(1, 40), st.sampled_from([None, 0, 3]), st.booleans())
def test_items_do_not_depend_on_where_the_bytes_are_cut(values, size, indent, escaped):
    data = json.dumps(values, indent=indent, ensure_ascii=escaped).encode("utf-8", "surrogatepass" if escaped else "strict")
    assert items(b" \n" + data + b"\n ", size) == values


@pytest.mark.parametrize("data", [
    b"", b"  ", b"{}", b"[1, 2", b"[1 2]", b"[1,]", b"[1] x", b'["a]', b"[,1]", b"[nope, 1, 2, 3, 4, 5, 6, 7]", b'[{"a": 1]', b"[1e]",
])
def test_broken_arrays_are_errors(data):
    for size in (1, 3, 100):
        with pytest.raises(ValueError):
            items(data, size)


def test_a_large_array_is_never_held():
    """80 MB of items in chunks of 256 KB, and one item of 4 MB."""
    item = json.dumps({"id": 1, "regions": [{"phrase": "x" * 500}] * 4}).encode() + b","
    block = item * 128
    large = json.dumps({"id": 2, "text": "y" * (4 << 20)}).encode()
    chunks = itertools.chain([b"["], itertools.repeat(block, 300), pieces(large, 1 << 18), [b"]"])
    tracemalloc.start()
    total = sum(1 for _ in array_items(chunks))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert total == 300 * 128 + 1 and peak < 40 << 20


def write_zip(path, **members):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, content in members.items():
            archive.writestr(name, content)


def test_zipped_metadata_and_regions(spark, tmp_path):
    metadata = [{"image_id": 1, "url": "u", "width": 2, "height": 3, "extra": {"a": []}}, {"image_id": 2, "url": None}]
    write_zip(tmp_path / "meta.zip", first=json.dumps(metadata, indent=1), second="not read")
    rows = sources.read_image_metadata(spark, str(tmp_path / "meta.zip"), zipped=True).orderBy("pos").collect()
    assert [(r.pos, r.image_id, r.url, r.width) for r in rows] == [(1, 1, "u", 2), (2, 2, None, None)]
    folder = tmp_path / "regions"
    folder.mkdir()
    for name, ids in (("b", [3, 4]), ("a", [1, 2]), ("c", [])):
        write_zip(folder / f"{name}.zip", only=json.dumps([{"id": i, "regions": [{"phrase": f"p{i}", "x": 1}], "z": 0} for i in ids]))
    (folder / "readme.txt").write_text("not a zip file")
    regions = sources.read_regions(spark, str(folder), zipped=True)
    assert [(r.pos, r.id, r.regions[0].phrase) for r in regions.orderBy("pos").collect()] == [(i, i, f"p{i}") for i in range(1, 5)]
    assert regions.schema["regions"].dataType == S.REGION_SCHEMA["regions"].dataType


def test_only_asked_fields_and_where_items_come_from(spark, tmp_path):
    for i in range(3):
        write_zip(tmp_path / f"{i}.zip", only=json.dumps([{"image_id": i * 10 + k, "url": "u", "more": [k]} for k in range(4)]))
    table = sources.read_zipped_arrays(spark, str(tmp_path), S.IMAGE_METADATA_SCHEMA)
    assert table.columns == ["zip_file", "zip_item", *S.IMAGE_METADATA_SCHEMA.fieldNames()]
    rows = table.filter(table.zip_file.endswith("1.zip")).orderBy("zip_item").collect()
    assert [(r.zip_item, r.image_id, r.width) for r in rows] == [(k, 10 + k, None) for k in range(4)]
    assert table.rdd.getNumPartitions() == 3
    (tmp_path / "2.zip").write_text("broken")
    with pytest.raises(Exception, match="zip"):
        table.collect()


def test_no_files_and_wrong_items(spark, tmp_path):
    assert sources.read_regions(spark, str(tmp_path), zipped=True).count() == 0
    write_zip(tmp_path / "x.zip", only="[1, 2]")
    with pytest.raises(Exception, match="no object"):
        sources.read_zipped_arrays(spark, str(tmp_path), S.REGION_SCHEMA).collect()
