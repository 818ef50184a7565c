"""Pileup files as a data source of their own: planned byte ranges, wanted values and columns, ranges left out by zones.

``spark.read.format("pileup").load(folder)`` gives typed rows of all files. A file is cut into ranges of bytes; a line
belongs to the range in which it begins. Only the columns asked for are parsed. Which chromosomes and modifications are
wanted is decided while reading, and by what :func:`write_zones` has noted of each range before reading: a range that
cannot hold a wanted row is no task at all. Files are opened through Arrow, so local paths and the stores that Arrow
reaches work.

What is wanted is said by options, not by filters that Spark pushes: in Spark 4.1 all scans of one loaded table share one
reader, so a filter pushed for one use of a frame would also hold for its other uses.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .readers import IMPUTED, KINDS, PILEUP

# The planning process of a session may not have the library on its path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bytes of a range, and of the lines that are parsed at once.
RANGE, BLOCK = 64 << 20, 4 << 20
#: Columns of which wanted values can be given.
CHOSEN = ("chrom", "mod_code")
#: A range of more distinct values than these is noted as holding any.
MOST_NAMES = 64
ZONES = "_zones"
COLUMNS = {"sample": "string", "chrom": "string", "start": "bigint", "end": "bigint", "mod_code": "string", "strand": "string", "n_valid": "bigint", "fraction": "double"}
WHOLE = r"^[+-]?[0-9]{1,18}$"
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]{1,3})?$"


@dataclass
class Range(InputPartition):
    """Bytes ``start`` to ``end`` of a file; an end of -1 is the whole of a compressed file."""

    uri: str
    start: int
    end: int


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """The store of a path and the path in it. ``file:/x``, as Spark writes it, is a local path."""
    if uri.startswith("file:"):
        uri = "/" + uri[5:].lstrip("/")
    return (fs.LocalFileSystem(), uri) if "://" not in uri else fs.FileSystem.from_uri(uri)


def files(paths: list[str]) -> list[tuple[str, int, float]]:
    """URI, size and time of change of the files under the paths, in order; names that begin with . or _ are left out."""
    out = []
    for uri in paths:
        store, path = opened(uri)
        info = store.get_file_info(path)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(uri)
        under = [info] if info.is_file else store.get_file_info(fs.FileSelector(path, recursive=True))
        for f in under:
            inner = f.path[len(path) :] if not info.is_file else f.base_name
            if f.is_file and not any(part[:1] in ("_", ".") for part in inner.split("/")):
                scheme = uri[: uri.index("://") + 3] if "://" in uri and not uri.startswith("file:") else ""
                out.append((scheme + f.path, f.size, f.mtime.timestamp() if f.mtime else 0.0))
    return sorted(out)


def ranges(found: list[tuple[str, int, float]], size: int) -> list[Range]:
    return [r for uri, n, _ in found for r in ([Range(uri, 0, -1)] if uri.endswith((".gz", ".bgz")) else [Range(uri, at, min(n, at + size)) for at in range(0, n, size)])]


def lines_of(part: Range, block: int = BLOCK) -> Iterator[bytes]:
    """The lines that begin in the range, in blocks of whole lines, a longer line by itself."""
    store, path = opened(part.uri)
    if part.end < 0:
        with store.open_input_stream(path, compression="gzip") as f:
            yield from _blocks(f, block, None)
        return
    with store.open_input_file(path) as f:
        at = part.start
        if at:  # the line before ends with the first newline from the byte before on
            at -= 1
            while True:
                f.seek(at)
                got = f.read(1 << 16)
                cut = got.find(b"\n")
                if cut >= 0 or not got:
                    at += cut + 1
                    break
                at += len(got)
        if at < part.end:
            f.seek(at)
            yield from _blocks(f, block, part.end - at)


def _blocks(f: pa.NativeFile, block: int, left: int | None) -> Iterator[bytes]:
    """``left`` bytes of lines and the rest of the line that they end in; all of them where it is None."""
    rest = b""
    while left is None or left > 0:
        got = f.read(block if left is None else min(block, left))
        if not got:
            break
        left = None if left is None else left - len(got)
        rest += got
        cut = rest.rfind(b"\n") + 1
        if cut:
            yield rest[:cut]
            rest = rest[cut:]
    while rest and not rest.endswith(b"\n") and (got := f.read(1 << 16)):
        cut = got.find(b"\n") + 1
        rest += got[:cut] if cut else got
    if rest:
        yield rest


def parsed(block: bytes, layout: dict[str, int]) -> dict[str, pa.Array]:
    """Columns of a layout from whole lines; comments and blank lines go, what is missing or no number is null."""
    lines = pc.split_pattern(pa.array([block.decode("utf-8", "replace")]), "\n").flatten()
    lines = pc.utf8_rtrim(lines, characters="\r")
    lines = lines.filter(pc.invert(pc.or_(pc.starts_with(lines, "#"), pc.equal(pc.utf8_trim_whitespace(lines), ""))))
    fields, out = pc.split_pattern(lines, "\t"), {}
    for name, at in layout.items():
        value = pc.list_slice(fields, start=at, stop=at + 1, return_fixed_size_list=True).flatten()
        value = pc.utf8_trim_whitespace(value)
        if kind := KINDS.get(name):
            good = pc.match_substring_regex(value, WHOLE if kind == "bigint" else NUMBER)
            value = pc.if_else(good, value, None).cast(pa.int64() if kind == "bigint" else pa.float64())
        elif name in CHOSEN or name == "strand":
            value = pc.if_else(pc.equal(value, ""), None, value)
        out[name] = value
    return out


def sample_of(uri: str) -> str:
    """The value of a folder ``sample=...`` on the path, else the file's name up to its first dot."""
    *folders, name = uri.split("/")
    return next((unquote(f[7:]) for f in reversed(folders) if f.startswith("sample=")), name.partition(".")[0])


def columns_of(options: dict[str, str]) -> list[str]:
    names = options["columns"].split(",") if "columns" in options else list(COLUMNS)
    if unknown := set(names) - set(COLUMNS):
        raise ValueError(f"no columns of a pileup: {sorted(unknown)}")
    return names


class PileupReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.paths = [p for p in options["path"].split(",") if p]
        self.imputed = options.get("layout", "pileup") == "imputed"
        self.size = int(options.get("rangebytes", RANGE))
        self.columns = columns_of(options)
        self.wanted = {name: set(options[key].split(",")) for name in CHOSEN if (key := name.replace("_", "")) in options}
        self.read_ranges = self.skipped_ranges = 0

    def partitions(self) -> list[Range]:
        found = files(self.paths)
        every = ranges(found, self.size)
        noted = self.zones(found) if self.wanted else {}
        kept = [r for r in every if self.can_hold(noted.get((r.uri, r.start, r.end)))]
        self.read_ranges, self.skipped_ranges = len(kept), len(every) - len(kept)
        return kept or [Range("", 0, 0)]

    def can_hold(self, zone: dict | None) -> bool:
        return zone is None or all(zone[name] is None or not values.isdisjoint(zone[name]) for name, values in self.wanted.items())

    def zones(self, found: list[tuple[str, int, float]]) -> dict[tuple[str, int, int], dict]:
        """What has been noted of ranges of files that have not changed since."""
        import pyarrow.dataset as ds

        now, out = {uri: (size, at) for uri, size, at in found}, {}
        for uri in self.paths:
            store, path = opened(uri)
            if store.get_file_info(f"{path}/{ZONES}").type == fs.FileType.Directory:
                for batch in ds.dataset(f"{path}/{ZONES}", filesystem=store, format="parquet").to_batches(columns=["uri", "start", "end", "size", "changed", *CHOSEN]):
                    out |= {(z["uri"], z["start"], z["end"]): z for z in batch.to_pylist() if now.get(z["uri"]) == (z["size"], z["changed"])}
        return out

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        if not partition.uri:
            return
        sample = sample_of(partition.uri)
        layout = IMPUTED if self.imputed else PILEUP
        needed = {*self.columns, *self.wanted, "start"}
        for block in lines_of(partition):
            cols = parsed(block, {name: at for name, at in layout.items() if name in needed})
            n = len(cols["start"])
            cols["sample"] = pa.array([sample] * n, pa.string())
            if self.imputed:
                cols["mod_code"] = pa.array(["m"] * n, pa.string())
            keep = pc.is_valid(cols["start"]) if self.imputed else pa.array([True] * n)
            for name, values in self.wanted.items():
                keep = pc.and_(keep, pc.is_in(cols[name], pa.array(sorted(values), pa.string())))
            yield pa.RecordBatch.from_pydict({name: cols[name] for name in self.columns}).filter(keep)


class PileupSource(DataSource):
    """Options: ``path``, one or several by commas; ``layout``, pileup or imputed; ``rangeBytes``; ``columns``, ``chrom`` and
    ``modCode``, each one or several by commas."""

    @classmethod
    def name(cls) -> str:
        return "pileup"

    def schema(self) -> str:
        return ", ".join(f"{name} {COLUMNS[name]}" for name in columns_of({k.lower(): v for k, v in self.options.items()}))

    def reader(self, schema) -> PileupReader:
        return PileupReader({k.lower(): v for k, v in self.options.items()})


def register(spark: SparkSession) -> None:
    """Make the format known to a session."""
    spark.dataSource.register(PileupSource)


def scan(spark: SparkSession, path: str | list[str], layout: str = "pileup", chroms: list[str] | None = None, mod_codes: list[str] | None = None,
         columns: list[str] | None = None, range_bytes: int = RANGE) -> DataFrame:
    """Rows of pileup files: ``sample`` (of a folder ``sample=...``, else a file's name up to its first dot) and the typed columns of the layout.

    ``chroms`` and ``mod_codes`` are the values wanted, as the files write them; ``columns`` those to parse and return.
    Comments and blank lines are no rows, nor is what has no start in the layout after imputation (its header). Fields
    that are missing, empty or no number are null. A folder without files gives no rows.
    """
    register(spark)
    chosen = {"columns": columns, "chrom": chroms, "modCode": mod_codes}
    options = {"layout": layout, "rangeBytes": str(range_bytes)} | {k: ",".join(v) for k, v in chosen.items() if v is not None}
    return spark.read.format("pileup").options(**options).load(path if isinstance(path, str) else ",".join(path))


def write_zones(spark: SparkSession, folder: str, layout: str = "pileup", range_bytes: int = RANGE) -> None:
    """Note what chromosomes and modifications each range of the folder's files holds, in a table inside the folder.

    One pass over the files, a row for each range. A file that changes later is read whole again, whatever is noted.
    """
    found = files([folder])
    rows = [(r.uri, r.start, r.end, *next((size, at) for uri, size, at in found if uri == r.uri)) for r in ranges(found, range_bytes)]
    columns = IMPUTED if layout == "imputed" else PILEUP

    def noted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                held: dict[str, set] = {name: set() for name in CHOSEN}
                for block in lines_of(Range(row["uri"], row["start"], row["end"])):
                    cols = parsed(block, {name: at for name, at in columns.items() if name in CHOSEN})
                    for name in CHOSEN:
                        held[name] |= set(pc.unique(cols[name]).to_pylist()) if name in cols else {"m"}  # all are, after imputation
                row |= {name: sorted(v for v in values if v is not None) if len(values) <= MOST_NAMES else None for name, values in held.items()}
                yield pa.RecordBatch.from_pylist([row], pa.schema([("uri", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("size", pa.int64()), ("changed", pa.float64()), *((n, pa.list_(pa.string())) for n in CHOSEN)]))

    kinds = "uri string, start bigint, end bigint, size bigint, changed double"
    todo = spark.createDataFrame(rows, kinds).repartition(max(1, min(len(rows), 10_000)), "uri", "start")
    names = ", ".join(f"{n} array<string>" for n in CHOSEN)
    todo.mapInArrow(noted, f"{kinds}, {names}").write.mode("overwrite").parquet(f"{folder}/{ZONES}")
