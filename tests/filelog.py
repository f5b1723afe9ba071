"""A log in a folder, one subfolder per shard, as a client for the log data source; for tests only."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq

from millrace.sources.log import ARROW

# Staged rows are written in row groups of about this size.
GROUP_BYTES = 8 << 20


def _group_rows(file: pq.ParquetFile) -> list[int]:
    return [file.metadata.row_group(i).num_rows for i in range(file.num_row_groups)]


class FileLog:
    """A log kept as Parquet segments in a shared folder, one subfolder per shard.

    A segment's name is its first and next sequence number. Writers stage segments and the commit on the driver numbers
    them by renaming. Records of a task keep their order; arrival is stamped by the caller or at write time.
    """

    def __init__(self, options: dict[str, str]):
        where = options["stream"]
        if where.startswith("file:/"):
            where = "/" + where.removeprefix("file:").lstrip("/")
        self.fs, self.root = pafs.FileSystem.from_uri(where)
        self.count = self._shard_count(options.get("shards"))
        self.rows_per_piece = int(options.get("rowsPerPiece", "1000000"))

    def _shard_count(self, asked: str | None) -> int:
        """A log keeps its number of shards; the first writer sets it (4 unless told), others must agree or not ask."""
        path = f"{self.root}/_shards"
        if self.fs.get_file_info(path).type != pafs.FileType.NotFound:
            with self.fs.open_input_stream(path) as handle:
                kept = int(handle.read())
            if asked is not None and int(asked) != kept:
                raise ValueError(f"the log has {kept} shards, not {asked}")
            return kept
        return int(asked or "4")

    def create(self) -> None:
        """Note the number of shards of a new log."""
        path = f"{self.root}/_shards"
        if self.fs.get_file_info(path).type == pafs.FileType.NotFound:
            self.fs.create_dir(self.root, recursive=True)
            with self.fs.open_output_stream(path) as handle:
                handle.write(str(self.count).encode())

    def shards(self) -> list[str]:
        return [f"shard-{i:06d}" for i in range(self.count)]

    def _segments(self, shard: str) -> list[tuple[int, int, str]]:
        selector = pafs.FileSelector(f"{self.root}/{shard}", allow_not_found=True)
        found = []
        for info in self.fs.get_file_info(selector):
            first, _, rest = info.base_name.partition("-")
            if rest.endswith(".parquet"):
                found.append((int(first), int(rest.removesuffix(".parquet")), info.path))
        return sorted(found)

    def bounds(self, shard: str) -> tuple[int, int]:
        segments = self._segments(shard)
        return (segments[0][0], segments[-1][1]) if segments else (0, 0)

    def at_timestamp(self, shard: str, micros: int) -> int:
        """Sequence number of the first record that arrived at or after the time.

        Row groups whose newest record is older are passed over by their statistics, unread.
        """
        limit = pa.scalar(micros, pa.timestamp("us", tz="UTC"))
        for first, _, path in self._segments(shard):
            with self.fs.open_input_file(path) as handle:
                file = pq.ParquetFile(handle)
                for group, rows in enumerate(_group_rows(file)):
                    newest = file.metadata.row_group(group).column(0).statistics
                    if newest is None or not newest.has_min_max or newest.max >= limit.as_py():
                        arrival = file.read_row_group(group, columns=["arrival"])["arrival"]
                        at = pc.index(pc.greater_equal(arrival, limit), True).as_py()
                        if at >= 0:
                            return first + at
                    first += rows
        return self.bounds(shard)[1]

    def pieces(self, shard: str, start: int, end: int) -> list[tuple[str, str, int, int, int]]:
        """(shard, path, first, from, to) for what overlaps [start, end), at most ``rows_per_piece`` rows in each."""
        found = []
        for first, after, path in self._segments(shard):
            low, high = max(first, start), min(after, end)
            for at in range(low, high, self.rows_per_piece):
                found.append((shard, path, first, at, min(at + self.rows_per_piece, high)))
        return found

    def read(self, piece: tuple[str, str, int, int, int]) -> Iterator[pa.RecordBatch]:
        shard, path, at, start, end = piece
        with self.fs.open_input_file(path) as handle:
            file = pq.ParquetFile(handle)
            for group, held in enumerate(_group_rows(file)):
                if at < end and at + held > start:
                    skip, take = max(0, start - at), min(held, end - at)
                    for batch in file.read_row_group(group).slice(skip, take - skip).to_batches(65536):
                        numbers = pa.array(np.arange(at + skip, at + skip + batch.num_rows))
                        shards = pa.repeat(pa.scalar(shard), batch.num_rows)
                        columns = [shards, numbers, batch["arrival"], batch["key"], batch["data"]]
                        yield pa.record_batch(columns, schema=ARROW)
                        skip += batch.num_rows
                at += held

    def stage(self, batches: Iterator[pa.RecordBatch]) -> list[tuple[str, str, int]]:
        """Write the batches to one staged file per shard; (shard, path, rows) of each."""
        shards, token = self.shards(), uuid.uuid4().hex
        writers, held, rows = {}, {}, {}
        self.fs.create_dir(f"{self.root}/_staged", recursive=True)
        schema = pa.schema([ARROW.field("arrival"), ARROW.field("key"), ARROW.field("data")])

        def flush(home: int) -> None:
            if home not in writers:
                path = f"{self.root}/_staged/{token}-{home}.parquet"
                writers[home] = (pq.ParquetWriter(path, schema, filesystem=self.fs), path)
            writers[home][0].write_table(pa.concat_tables(held.pop(home)))

        for batch in batches:
            table = pa.table({name: batch[name].cast(schema.field(name).type) for name in schema.names}, schema=schema)
            keys = table["key"].combine_chunks().fill_null("").dictionary_encode()
            places = pa.array([zlib.crc32(k.encode()) % self.count for k in keys.dictionary.to_pylist()], pa.int32())
            homes = places.take(keys.indices)
            for home in pc.unique(homes).to_pylist():
                part = table.filter(pc.equal(homes, home))
                held.setdefault(home, []).append(part)
                rows[home] = rows.get(home, 0) + part.num_rows
                if sum(t.nbytes for t in held[home]) >= GROUP_BYTES:
                    flush(home)
        for home in list(held):
            flush(home)
        for writer, _ in writers.values():
            writer.close()
        return [(shards[home], path, rows[home]) for home, (_, path) in writers.items()]

    def publish(self, staged: list[tuple[str, str, int]], batch_id: str) -> None:
        """Number the staged files. A batch that was published before is left out, so replays add nothing."""
        self.create()
        marker = f"{self.root}/_published/{batch_id}"
        if self.fs.get_file_info(marker).type != pafs.FileType.NotFound:
            return
        after = {shard: self.bounds(shard)[1] for shard in {s for s, _, _ in staged}}
        for shard, path, rows in staged:
            self.fs.create_dir(f"{self.root}/{shard}", recursive=True)
            first, after[shard] = after[shard], after[shard] + rows
            self.fs.move(path, f"{self.root}/{shard}/{first:020d}-{after[shard]:020d}.parquet")
        self.fs.create_dir(f"{self.root}/_published", recursive=True)
        self.fs.open_output_stream(marker).close()
