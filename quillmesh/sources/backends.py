"""Mailboxes behind one interface, readable as a Spark data source. Connections are given, so tests need no network."""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


class Backend(Protocol):
    """A mailbox: ids since a day (null: all), and raw messages of ids, as (id, bytes)."""

    def list_ids(self, since: str | None) -> list[str]: ...

    def fetch(self, ids: list[str]) -> Iterator[tuple[str, bytes]]: ...


def decode(value: str) -> bytes:
    """base64url, padded or not."""
    return base64.urlsafe_b64decode(value + "=" * (-len(value) % 4))


class ApiBackend:
    """Pages of 500 ids, raw messages as base64url. call(path, parameters) gives the reply as a dictionary."""

    def __init__(self, call: Callable[[str, dict], dict]) -> None:
        self.call = call

    def list_ids(self, since: str | None) -> list[str]:
        out, page = [], {"maxResults": 500} | ({"q": "after:" + since[:10].replace("-", "/")} if since else {})
        while True:
            reply = self.call("messages", page)
            out += [m["id"] for m in reply.get("messages", [])]
            if not reply.get("nextPageToken"):
                return out
            page = page | {"pageToken": reply["nextPageToken"]}

    def fetch(self, ids: list[str]) -> Iterator[tuple[str, bytes]]:
        for i in ids:
            yield i, decode(self.call(f"messages/{i}", {"format": "raw"})["raw"])


class ImapBackend:
    """search(since) gives uids, fetch(uid) gives (message number, bytes); connect() gives both. Newest first; three drops in a
    row end the run."""

    def __init__(self, connect: Callable[[], object], drops: int = 3) -> None:
        self.connect, self.drops = connect, drops
        self.at: object | None = None

    def _do(self, what: str, *given: object) -> object:
        for k in range(self.drops):
            try:
                self.at = self.at or self.connect()
                return getattr(self.at, what)(*given)
            except (OSError, EOFError):
                self.at = None
                if k + 1 == self.drops:
                    raise
        raise AssertionError

    def list_ids(self, since: str | None) -> list[str]:
        return [str(u) for u in sorted(map(int, self._do("search", since)), reverse=True)]

    def fetch(self, ids: list[str]) -> Iterator[tuple[str, bytes]]:
        for u in ids:
            number, raw = self._do("fetch", u)
            yield format(int(number), "x"), raw


class _Chunk(InputPartition):
    def __init__(self, ids: list[str]) -> None:
        self.ids = ids


class _Reader(DataSourceReader):
    def __init__(self, options: dict, make: Callable[[dict], Backend]) -> None:
        self.options, self.make = options, make

    def partitions(self) -> list[_Chunk]:
        ids, size = self.make(self.options).list_ids(self.options.get("since")), int(self.options.get("chunk", "200"))
        return [_Chunk(ids[k : k + size]) for k in range(0, len(ids), size)] or [_Chunk([])]

    def read(self, partition: _Chunk) -> Iterator[tuple[str, bytes]]:
        yield from self.make(self.options).fetch(partition.ids)


def register(spark: SparkSession, name: str, make: Callable[[dict], Backend]) -> None:
    """Makes spark.read.format(name) read a mailbox: ids are listed once, messages fetched by chunks in the tasks."""

    class Mailbox(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return "message_id string, content binary"

        def reader(self, schema: object) -> DataSourceReader:
            return _Reader(dict(self.options), make)

    spark.dataSource.register(Mailbox)


def new_messages(spark: SparkSession, name: str, known: DataFrame, since: str | None = None) -> DataFrame:
    """Messages of a registered mailbox whose id is not known yet."""
    reader = spark.read.format(name)
    found = (reader.option("since", since) if since else reader).load()
    return found.join(known.select("message_id"), "message_id", "left_anti")
