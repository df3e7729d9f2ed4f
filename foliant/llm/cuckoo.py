"""A cuckoo-filter index over digests."""

from __future__ import annotations

from collections.abc import Iterator

SLOTS = 4
MAX_KICKS = 96


class CuckooIndex:
    """Sixteen-bit fingerprints in buckets of four, each beside its stored entry.

    A fingerprint hit is only a hint: it is verified against the whole digest
    kept in the same bucket slot.  Entries can be inserted and deleted at any
    time; when an insertion finds no place after ``MAX_KICKS`` relocations the
    table doubles and is rebuilt from the stored digests.  Entries are
    ``[digest, keep_id, count]`` lists; memory is proportional to live entries.
    """

    def __init__(self, buckets: int = 256) -> None:
        self._reset(buckets)

    def _reset(self, buckets: int) -> None:
        self.mask = buckets - 1
        self.prints = [0] * (buckets * SLOTS)
        self.entries: list = [None] * (buckets * SLOTS)
        self.live = 0

    def __len__(self) -> int:
        return self.live

    def __iter__(self) -> Iterator[list]:
        return (e for e in self.entries if e is not None)

    def _homes(self, digest: bytes) -> tuple[int, int, int]:
        mark = int.from_bytes(digest[8:10], "little") or 1
        first = int.from_bytes(digest[:8], "little") & self.mask
        return mark, first, self._other(first, mark)

    def _other(self, bucket: int, mark: int) -> int:
        return bucket ^ ((mark * 0x5BD1E995) & self.mask)

    def _slot(self, digest: bytes) -> int:
        mark, first, second = self._homes(digest)
        for bucket in (first, second):
            for slot in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if self.prints[slot] == mark and self.entries[slot][0] == digest:
                    return slot
        return -1

    def find(self, digest: bytes) -> list | None:
        slot = self._slot(digest)
        return None if slot < 0 else self.entries[slot]

    def delete(self, digest: bytes) -> list | None:
        slot = self._slot(digest)
        if slot < 0:
            return None
        entry, self.prints[slot], self.entries[slot] = self.entries[slot], 0, None
        self.live -= 1
        return entry

    def insert(self, entry: list) -> None:
        """Add an entry whose digest is not live yet."""
        mark, first, second = self._homes(entry[0])
        bucket = first
        for kick in range(MAX_KICKS):
            for home in (first, second) if not kick else (bucket,):
                for slot in range(home * SLOTS, home * SLOTS + SLOTS):
                    if not self.prints[slot]:
                        self.prints[slot], self.entries[slot] = mark, entry
                        self.live += 1
                        return
            slot = bucket * SLOTS + kick % SLOTS
            mark, self.prints[slot] = self.prints[slot], mark
            entry, self.entries[slot] = self.entries[slot], entry
            bucket = self._other(bucket, mark)
        held = [*self, entry]
        self._reset(2 * (self.mask + 1))
        for e in held:
            self.insert(e)

    def drain(self) -> list[list]:
        """Delete and return every live entry."""
        held = list(self)
        for e in held:
            self.delete(e[0])
        return held
