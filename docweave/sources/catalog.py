"""Versioned entity definitions: one JSON file an entity and one a version, in a folder that Spark's file systems reach."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import INVALID_METADATA, UNKNOWN_ENTITY, UNKNOWN_VERSION, DocumentError
from .store import Store

STATUSES = ("active", "deprecated", "disabled")
#: What a role may be allowed on an entity; find and update also on a field.
OPERATIONS = ("find", "insert", "update", "delete")
ANYONE = "anyone"


@dataclass
class Entity:
    """What holds for all versions of an entity: where its documents lie, its default version and its indexes."""

    name: str
    path: str
    default_version: str | None = None
    indexes: list[dict[str, Any]] = field(default_factory=list)
    manage_indexes: bool | None = None


@dataclass
class Version:
    """One version's fields (a Spark schema as JSON), status with its history, and roles by operation for the entity and for field paths."""

    name: str
    version: str
    schema: str
    status: str = "active"
    history: list[str] = field(default_factory=list)
    access: dict[str, list[str]] = field(default_factory=dict)
    field_access: dict[str, dict[str, list[str]]] = field(default_factory=dict)

    def struct(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema))

    def allows(self, operation: str, roles: set[str]) -> bool:
        """Nobody is named: everybody may."""
        named = self.access.get(operation)
        return named is None or ANYONE in named or bool(roles & set(named))

    def hidden(self, operation: str, roles: set[str]) -> list[str]:
        """Field paths that these roles may not read or write."""
        return sorted(p for p, by in self.field_access.items() if operation in by and ANYONE not in by[operation] and not roles & set(by[operation]))

    def view(self, documents: DataFrame) -> DataFrame:
        """The stored documents as this version sees them: declared root fields in order, missing ones null."""
        have = set(documents.columns)
        return documents.select(*[(F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in self.struct().fields])


class Catalog:
    """Entities and versions; reads are remembered until the folder's newest change."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self._make = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._make(self.path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
        self._cache: dict[str, tuple[tuple[int, int], dict[str, Any]]] = {}

    def _files(self) -> dict[str, tuple[int, int]]:
        folder = self._make(self.path)
        if not self._fs.exists(folder):
            return {}
        found = {s.getPath().getName(): (s.getModificationTime(), s.getLen()) for s in self._fs.listStatus(folder)}
        return {k: v for k, v in found.items() if k.endswith(".json")}

    def _read(self, file: str) -> dict[str, Any] | None:
        mark = self._files().get(file)
        if mark is None:
            return None
        if self._cache.get(file, (None,))[0] != mark:
            text = "\n".join(r[0] for r in self.spark.read.text(f"{self.path}/{file}", wholetext=True).collect())
            self._cache[file] = mark, json.loads(text)
        return self._cache[file][1]

    def _write(self, file: str, value: Any, fresh: bool) -> None:
        try:
            out = self._fs.create(self._make(f"{self.path}/{file}"), not fresh)
        except Exception as e:
            raise DocumentError(INVALID_METADATA, f"{file} exists") from e
        out.write(bytearray(json.dumps(asdict(value)).encode()))
        out.close()
        self._cache.pop(file, None)

    @staticmethod
    def _file(name: str, version: str | None = None) -> str:
        if not name or any(c in name + (version or "") for c in "|/\\"):
            raise DocumentError(INVALID_METADATA, f"name {name!r}")
        return f"{name}|{version or ''}.json"

    def names(self, statuses: set[str] | None = None) -> list[str]:
        """Entities, or those with a version of one of the statuses."""
        known = sorted(f.split("|")[0] for f in self._files() if f.endswith("|.json"))
        return known if statuses is None else [n for n in known if any(self.version(n, v).status in statuses for v in self.versions(n))]

    def versions(self, name: str) -> list[str]:
        return sorted(f.split("|")[1].removesuffix(".json") for f in self._files() if f.split("|")[0] == name and not f.endswith("|.json"))

    def entity(self, name: str) -> Entity:
        found = self._read(self._file(name))
        if found is None:
            raise DocumentError(UNKNOWN_ENTITY, name)
        return Entity(**found)

    def version(self, name: str, version: str | None = None) -> Version:
        """A version, or the default one."""
        wanted = version or self.entity(name).default_version
        found = self._read(self._file(name, wanted)) if wanted else None
        if found is None:
            raise DocumentError(UNKNOWN_VERSION, f"{name} {wanted}")
        return Version(**found)

    def documents(self, name: str, version: str | None = None) -> DataFrame:
        """The entity's documents as a version (the default one) sees them: its path holds a store's snapshots or plain Parquet files."""
        entity, seen = self.entity(name), self.version(name, version)
        if seen.status == "disabled":
            raise DocumentError(UNKNOWN_VERSION, f"{name} {seen.version} is disabled")
        store = Store(self.spark, entity.path)
        return seen.view(store.read() if store.versions() else self.spark.read.parquet(entity.path))

    def create(self, entity: Entity, first: Version) -> None:
        """A new entity with its first version; if the version can't be written, neither is the entity."""
        if entity.default_version not in (None, first.version):
            raise DocumentError(INVALID_METADATA, "the default version does not exist")
        self._write(self._file(entity.name), entity, True)
        try:
            self.add(first)
        except Exception:
            self._fs.delete(self._make(f"{self.path}/{self._file(entity.name)}"), False)
            raise

    def add(self, version: Version) -> None:
        """A new version; one whose name has SNAPSHOT may be written again, others never."""
        self.entity(version.name)
        self._validate(version)
        self._write(self._file(version.name, version.version), version, "SNAPSHOT" not in version.version)

    def update(self, entity: Entity) -> None:
        """New information about an entity: indexes must name fields of every version that isn't disabled."""
        self.entity(entity.name)
        if entity.default_version is not None and self.version(entity.name, entity.default_version).status == "disabled":
            raise DocumentError(INVALID_METADATA, "the default version is disabled")
        for v in map(lambda x: self.version(entity.name, x), self.versions(entity.name)):
            if v.status != "disabled":
                self._validate(v, entity)
        self._write(self._file(entity.name), entity, False)

    def _validate(self, version: Version, entity: Entity | None = None) -> None:
        names = set(version.struct().names)
        if version.status not in STATUSES:
            raise DocumentError(INVALID_METADATA, f"status {version.status}")
        check_indexes((entity or self.entity(version.name)).indexes)
        wrong = [p for i in (entity or self.entity(version.name)).indexes for p in i["fields"] if p.split(".")[0] not in names]
        if wrong:
            raise DocumentError(INVALID_METADATA, f"index on unknown fields {wrong}")

    def set_status(self, name: str, version: str, status: str) -> None:
        """The old status is noted in the history; the default version can't be disabled."""
        if status not in STATUSES:
            raise DocumentError(INVALID_METADATA, f"status {status}")
        if status == "disabled" and self.entity(name).default_version == version:
            raise DocumentError(INVALID_METADATA, "the default version can't be disabled")
        found = self.version(name, version)
        found.history = [*found.history, found.status]
        found.status = status
        self._write(self._file(name, version), found, False)

    def remove(self, name: str) -> None:
        """Only an entity whose versions are all disabled, or that has no default version and none but disabled ones, goes."""
        self.entity(name)
        if any(self.version(name, v).status != "disabled" for v in self.versions(name)):
            raise DocumentError(INVALID_METADATA, f"{name} has versions that aren't disabled")
        for file in [*(self._file(name, v) for v in self.versions(name)), self._file(name)]:
            self._fs.delete(self._make(f"{self.path}/{file}"), False)

    def access_report(self) -> DataFrame:
        """Rows (role, operation, paths): for each role the entities, and entity.field paths, that it is named for."""
        all_versions = [self.version(n, v) for n in self.names() for v in self.versions(n)]
        return access_rows(self.spark, all_versions)


def access_rows(spark: SparkSession, versions: list[Version]) -> DataFrame:
    """The access report of some versions."""
    rows = [(r, op, v.name) for v in versions for op, roles in v.access.items() for r in roles]
    rows += [(r, op, f"{v.name}.{p}") for v in versions for p, by in v.field_access.items() for op, roles in by.items() for r in roles]
    return spark.createDataFrame(rows, "role string, operation string, path string").groupBy("role", "operation").agg(F.sort_array(F.collect_set("path")).alias("paths"))


def signature(index: dict[str, Any]) -> tuple[str, ...]:
    """What makes two indexes compete: their fields and directions, in order."""
    return tuple(f"{f}:{d}" for f, d in zip(index["fields"], index.get("directions", ["$asc"] * len(index["fields"])), strict=True))


def check_indexes(indexes: list[dict[str, Any]]) -> None:
    """No two indexes on the same fields, and none on the elements of an array as such (a path that ends in *)."""
    seen = [signature(i) for i in indexes]
    twice = sorted({s for s in seen if seen.count(s) > 1})
    if twice:
        raise DocumentError(INVALID_METADATA, f"two indexes on {twice}")
    if any(p.split(".")[-1] == "*" for i in indexes for p in i["fields"]):
        raise DocumentError(INVALID_METADATA, "an index path ends in *")


def manages_indexes(config: dict[str, Any], entity: Entity) -> bool:
    """Whether an entity's indexes are kept up: its own flag, else the configuration's lists of managed and unmanaged entities, else yes."""
    if entity.manage_indexes is not None:
        return entity.manage_indexes
    if config.get("managedEntities") is not None:
        return entity.name in config["managedEntities"]
    return entity.name not in (config.get("unmanagedEntities") or [])


def index_changes(declared: list[dict[str, Any]], existing: list[dict[str, Any]]) -> tuple[list[dict[str, Any]], list[dict[str, Any]]]:
    """Indexes to make and to drop so that those existing are those declared.

    A named index whose fields or options differ from the existing one of its name is made anew, and so is one that
    exists on the same fields under another name. An unnamed one stays if an index with its fields and options exists.
    What isn't declared goes; the unique index on _id always stays.
    """
    options = lambda i: {k: v for k, v in i.items() if k != "name"}
    kept: list[int] = []
    make = []
    for i in declared:
        same = [k for k, e in enumerate(existing) if k not in kept and signature(e) == signature(i) and options(e) == options(i) and (not i.get("name") or e.get("name") == i["name"])]
        if same:
            kept.append(same[0])
        else:
            make.append(i)
    return make, [e for k, e in enumerate(existing) if k not in kept and e["fields"] != ["_id"]]
