"""Parameters of an index, passed as an argument instead of read from a global."""

from __future__ import annotations

from dataclasses import dataclass

# Defaults every index starts from.
DEFAULT_CHUNK_SIZE = 1000
DEFAULT_CHUNK_OVERLAP = 100
DEFAULT_MODEL = "mxbai-embed-large"
DEFAULT_VERSION = "1.3.0"
DEFAULT_HOST = "http://localhost:11434"
DEFAULT_GLOB = "*.pdf"

BY_CONTENT = "by_content"
BY_ID = "by_id"


@dataclass(frozen=True)
class IndexConfig:
    """Where an index lives and how its rows are made.

    ``reuse`` decides when a stored vector still belongs to a chunk:
    ``by_content`` compares the chunk id and the chunk's content hash,
    ``by_id`` the (positional) chunk id alone.
    """

    table_path: str
    corpus_path: str | None = None
    glob: str = DEFAULT_GLOB
    recursive: bool = False
    # Names the extractor: files are read again when it changes.
    reader: str = ""
    chunk_size: int = DEFAULT_CHUNK_SIZE
    chunk_overlap: int = DEFAULT_CHUNK_OVERLAP
    model: str = DEFAULT_MODEL
    version: str = DEFAULT_VERSION
    host: str = DEFAULT_HOST
    # Vectors of another length are rejected. None: any length is taken.
    dimension: int | None = None
    reuse: str = BY_CONTENT
    embed_batch: int = 64
    # How many tasks the chunks to embed are spread over. None: one per core, and
    # more where a task would get over ``embed_task_chunks``.
    embed_partitions: int | None = None
    embed_task_chunks: int = 10_000
    # A run that would delete more than this share of the index stops instead.
    # None: no such limit.
    max_delete_fraction: float | None = None
    # Fold the runs into one after a commit, once the documents touched since the
    # last fold exceed this share of the index. None: only on request.
    compact_fraction: float | None = None
    # Hash buckets of the stored tables. Fixed when a table is created.
    buckets: int = 8
    # Key sets with a known count up to this are broadcast, larger ones shuffled.
    broadcast_rows: int = 1_000_000
    debug: bool = False

    def __post_init__(self) -> None:
        check_window(self.chunk_size, self.chunk_overlap)
        if self.reuse not in (BY_CONTENT, BY_ID):
            raise ValueError(f"reuse must be {BY_CONTENT!r} or {BY_ID!r}, got {self.reuse!r}")
        if self.max_delete_fraction is not None and not 0.0 <= self.max_delete_fraction <= 1.0:
            raise ValueError("max_delete_fraction must lie between 0 and 1")
        if self.buckets < 1:
            raise ValueError("buckets must be positive")
        if self.embed_batch < 1:
            raise ValueError("embed_batch must be positive")

    @property
    def reuse_keys(self) -> list[str]:
        return ["chunkId"] if self.reuse == BY_ID else ["chunkId", "chunkContentHash"]


def check_window(size: int, overlap: int) -> None:
    """The window must move forward: ``0 <= overlap < size``."""
    if not 0 <= overlap < size:
        raise ValueError(f"need 0 <= overlap < size, got size={size}, overlap={overlap}")
