"""Recordings as a Spark data source: blocks of samples read by byte range, and files written under a commit.

    spark.dataSource.register(WavBlocks)
    spark.read.format("wav_blocks").option("path", folder).option("blockSeconds", 10).load().where("start < 30 and end > 20")

Planning reads the headers alone. A recording is cut into tasks of about splitBytes, each a run of whole blocks, so a long one is read by many
tasks and a block costs its own bytes. Filters on path, start and end (which take spark.sql.python.filterPushdown.enabled, as blocks() sets it) leave out files and blocks
before they are opened. PCM of 8, 16, 24 and 32 bits and 32-bit floats are read; channels are averaged. A file that is cut off has the blocks that are there.

Written rows are (name, content). A task writes into a folder of its own beside the target, and files are moved at the commit; of a task that
runs twice only the committed one's folder is moved, and what is left of others goes with the staging folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage

from ..functions.signal import pcm

SCHEMA = "path string, rate int, total long, block long, first long, start double, end double, samples array<float>"
COLUMNS = [c.split()[0] for c in SCHEMA.split(", ")]
PCM, FLOAT, EXTENSIBLE = 1, 3, 0xFFFE
STAGING = "_staging"
#: Headers that the planner reads at a time.
AT_ONCE = 16


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI, or of a local path, and the path in it."""
    if "://" not in path:
        return fs.LocalFileSystem(), path.removeprefix("file:")
    return fs.FileSystem.from_uri(path)


@dataclass(frozen=True)
class Form:
    """What a header tells: where samples begin, how many frames there are, and their form."""

    rate: int
    channels: int
    width: int
    kind: int
    begin: int
    total: int

    @property
    def step(self) -> int:
        return self.channels * self.width

    @staticmethod
    def read(file) -> Form:
        if file.read(4) != b"RIFF" or not file.read(4) or file.read(4) != b"WAVE":
            raise ValueError("not a WAV file")
        known, size = None, file.size()
        while True:
            head = file.read(8)
            if len(head) < 8:
                raise ValueError("a WAV file without samples")
            name, length = head[:4], int.from_bytes(head[4:], "little")
            if name == b"fmt ":
                raw = file.read(length)
                kind, channels, rate, _, _, bits = np.frombuffer(raw[:16], np.dtype("<u2,<u2,<u4,<u4,<u2,<u2"))[0].tolist()
                known = int.from_bytes(raw[24:26], "little") if kind == EXTENSIBLE else kind, channels, rate, bits // 8
                file.seek(file.tell() + length % 2)
            elif name == b"data":
                if known is None or known[0] not in (PCM, FLOAT) or known[0] == FLOAT and known[3] != 4:
                    raise ValueError("only PCM and 32-bit floats are read")
                kind, channels, rate, width = known
                return Form(rate, channels, width, kind, file.tell(), min(length, size - file.tell()) // (channels * width))
            else:
                file.seek(file.tell() + length + length % 2)

    def samples(self, raw: bytes) -> np.ndarray:
        x = np.frombuffer(raw, "<f4").astype(np.float64) if self.kind == FLOAT else pcm(raw, self.width)
        return x.reshape(-1, self.channels).mean(1).astype(np.float32)


@dataclass
class Run(InputPartition):
    """Blocks first to last - 1 of a file."""

    path: str
    form: Form
    length: int
    first: int
    last: int

    @property
    def n_bytes(self) -> int:
        return (min(self.last * self.length, self.form.total) - self.first * self.length) * self.form.step


class WavReader(DataSourceReader):
    def __init__(self, options: dict):
        self.paths = [p for p in options["path"].split(",") if p]
        self.seconds, self.split = float(options.get("blockSeconds", 10)), int(options.get("splitBytes", 64 << 20))
        self.only: set[str] | None = None
        self.after, self.before = float("-inf"), float("inf")

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Narrows what is read; all filters are applied to rows again."""
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if column == "path" and isinstance(f, (EqualTo, In)):
                wanted = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.only = wanted if self.only is None else self.only & wanted
            elif column == "end" and isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                self.after = max(self.after, f.value)
            elif column == "start" and isinstance(f, (LessThan, LessThanOrEqual)):
                self.before = min(self.before, f.value)
            yield f

    def files(self) -> list[tuple[fs.FileSystem, str]]:
        out = []
        for given in self.paths:
            system, path = opened(given)
            info = system.get_file_info(path)
            if info.type == fs.FileType.NotFound:
                raise FileNotFoundError(given)
            found = [info] if info.is_file else system.get_file_info(fs.FileSelector(path, recursive=True))
            out += [(system, f.path) for f in found if f.is_file and f.path.lower().endswith(".wav") and not any(part[:1] in "_." for part in f.path[len(path) :].split("/") if part)]
        return sorted(set(p for _, p in out) and out, key=lambda x: x[1])

    def partitions(self) -> list[Run]:
        def plan(item) -> list[Run]:
            system, path = item
            if self.only is not None and path not in self.only:
                return []
            with system.open_input_file(path) as file:
                form = Form.read(file)
            length = max(1, round(self.seconds * form.rate))
            blocks = -(-form.total // length)
            each = max(1, self.split // (length * form.step))
            # A block is [k, k + 1) x length; those that end after `after` and start before `before`, both ends kept.
            low = max(0, int(np.floor(self.after * form.rate / length)) - 1) if np.isfinite(self.after) else 0
            high = min(blocks, int(np.floor(self.before * form.rate / length)) + 1) if np.isfinite(self.before) else blocks
            return [Run(path, form, length, k, min(k + each, high)) for k in range(low, high, each)]

        with ThreadPoolExecutor(AT_ONCE) as pool:
            return [r for runs in pool.map(plan, self.files()) for r in runs]

    def read(self, run: Run | None) -> Iterator[pa.RecordBatch]:
        if run is None:
            return
        form = run.form
        with opened(self.paths[0])[0].open_input_file(run.path) as file:
            for k in range(run.first, run.last):
                first = k * run.length
                n = min(run.length, form.total - first)
                file.seek(form.begin + first * form.step)
                x = form.samples(file.read(n * form.step))
                values = ([run.path], [form.rate], [form.total], [k], [first], [first / form.rate], [(first + len(x)) / form.rate])
                kinds = (pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
                lists = pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x, pa.float32()))
                yield pa.RecordBatch.from_arrays([*(pa.array(v, t) for v, t in zip(values, kinds, strict=True)), lists], COLUMNS)


@dataclass
class Written(WriterCommitMessage):
    folder: str
    names: list[str]


class FileWriter(DataSourceWriter):
    """Files of rows (name, content). Names must be unique; a name that is there already is replaced where the mode is overwrite, else refused."""

    def __init__(self, options: dict, overwrite: bool):
        self.path, self.overwrite = options["path"].rstrip("/"), overwrite

    def write(self, rows: Iterator) -> Written:
        system, path = opened(self.path)
        folder, names = f"{path}/{STAGING}/{uuid.uuid4().hex}", []
        system.create_dir(folder)
        for r in rows:
            if "/" in r["name"] or r["name"][:1] in ("", ".", "_"):
                raise ValueError(f"no name for a file: {r['name']!r}")
            with system.open_output_stream(f"{folder}/{r['name']}") as file:
                file.write(bytes(r["content"]))
            names.append(r["name"])
        return Written(folder, names)

    def commit(self, messages: list[Written | None]) -> None:
        system, path = opened(self.path)
        done = [m for m in messages if m]
        names = [n for m in done for n in m.names]
        there = {f.base_name for f in system.get_file_info(fs.FileSelector(path, allow_not_found=True)) if f.is_file}
        if len(set(names)) < len(names) or not self.overwrite and there & set(names):
            self.abort(messages)
            raise ValueError("a name is there twice")
        for m in done:
            for n in m.names:
                system.move(f"{m.folder}/{n}", f"{path}/{n}")
        self.abort(messages)

    def abort(self, messages: list[Written | None]) -> None:
        system, path = opened(self.path)
        if system.get_file_info(f"{path}/{STAGING}").type == fs.FileType.Directory:
            system.delete_dir(f"{path}/{STAGING}")


class WavBlocks(DataSource):
    @classmethod
    def name(cls) -> str:
        return "wav_blocks"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WavReader:
        return WavReader(self.options)

    def writer(self, schema, overwrite: bool) -> FileWriter:
        return FileWriter(self.options, overwrite)


def blocks(spark, path: str, seconds: float = 10.0, split_bytes: int = 64 << 20):
    """Blocks of samples of a file or a folder of recordings. Lets Spark hand filters to Python sources in this session."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WavBlocks)
    return spark.read.format(WavBlocks.name()).option("path", path).option("blockSeconds", str(seconds)).option("splitBytes", str(split_bytes)).load()


def save_files(files, path: str, mode: str = "append") -> None:
    """Files of rows (name, content) in a folder, all or none of them."""
    files.sparkSession.dataSource.register(WavBlocks)
    files.select("name", "content").write.format(WavBlocks.name()).option("path", path).mode(mode).save()
