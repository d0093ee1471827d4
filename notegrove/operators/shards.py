"""Searching one shard of the records in Arrow arrays, for all queries at once.

The text index lays its postings out by record: a shard holds everything about its records,
so a score is finished where it is begun and a task sends k records per query. ``Shard`` is
what a task holds: the postings of the wanted terms, numbered by record, in blocks of
ascending ids, each with the highest share of a score that any of its records can get.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from notegrove.functions.scores import DIGITS, share_of

# Scores are compared after rounding; what lies closer than this may still be level.
SLACK = 2 * 10.0**-DIGITS
FAR = 8  # fixed value: the largest distance two query words are charged for

Term = tuple[str, str]


def flat(column: pa.ChunkedArray) -> np.ndarray:
    return pc.list_flatten(column).to_numpy() if len(column) else np.empty(0, np.int64)


def starts_of(column: pa.ChunkedArray) -> np.ndarray:
    sizes = pc.list_value_length(column).to_numpy() if len(column) else np.empty(0, np.int64)
    return np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


class Shard:
    """Postings of one shard as arrays; records are numbered by their place among ``ids``."""

    def __init__(self, blocks: pa.Table, records: pa.Table | None = None, means: dict[str, float] | None = None):
        blocks = blocks.sort_by([("term", "ascending"), ("field", "ascending"), ("first", "ascending")])
        self.means = means or {}
        self.blocks = blocks
        posted = flat(blocks["ids"])
        self.records = None
        if records is None:
            self.ids = np.unique(posted)
        else:
            self.records = records.filter(pc.is_valid(records["id"])).sort_by("id")
            # A record may stand in several rows; ``row`` is where its rows begin.
            self.ids, row = np.unique(self.records["id"].to_numpy(), return_index=True)
            self.row = np.append(row, self.records.num_rows)
        at = np.searchsorted(self.ids, posted)
        known = self.ids[np.minimum(at, len(self.ids) - 1)] == posted if len(self.ids) else np.zeros(len(at), bool)
        # Postings of records that did not pass the filters count for an extra record.
        self.at = np.where(known, at, len(self.ids))
        self.start = starts_of(blocks["ids"])
        self.first, self.last = (np.searchsorted(self.ids, blocks[c].to_numpy()) for c in ("first", "last"))
        self.peak = blocks["peak"].to_numpy()
        self.field = blocks["field"].to_pylist()
        self.rows: dict[Term, tuple[int, int]] = {}
        for i, key in enumerate(zip(blocks["term"].to_pylist(), self.field, strict=True)):
            self.rows[key] = (self.rows[key][0] if key in self.rows else i, i + 1)
        self.skipped = 0

    def postings(self, term: Term) -> slice:
        lo, hi = self.rows.get(term, (0, 0))
        return slice(self.start[lo], self.start[hi])

    # --- Relevance ---

    def shares(self) -> np.ndarray:
        """Every posting's share of a score, before its term's weight."""
        if not hasattr(self, "_shares"):
            mean = np.repeat([self.means[f] for f in self.field], np.diff(self.start))
            self._shares = share_of(flat(self.blocks["tfs"]), flat(self.blocks["lens"]), mean)
        return self._shares

    def relevance(self, terms: Sequence[tuple[Term, float]], k: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Records and scores of all that a term matches, or of the k best and those level.

        Terms come by what they can add at most. When all that are left cannot lift a new
        record to the k-th score, only records that are still in the running are looked up,
        and blocks without any are skipped.
        """
        terms = [(self.rows[t], w) for t, w in terms if t in self.rows]
        most = np.array([w * self.peak[lo:hi].max() for (lo, hi), w in terms])
        order = np.argsort(-most, kind="stable")
        rest = np.append(np.cumsum(most[order][::-1])[::-1], 0.0)
        scores = np.zeros(len(self.ids) + 1)
        shares = self.shares()
        done, step = 0, 1
        while done < len(order):
            for i in order[done : done + step]:
                (lo, hi), weight = terms[i]
                mine = slice(self.start[lo], self.start[hi])
                # A record stands once in the postings of a term and field.
                scores[self.at[mine]] += weight * shares[mine]
            done, step = done + step, 2 * step
            if k is not None and done < len(order):
                floor = self._kth(scores[:-1], k) - SLACK
                if rest[done] < floor:
                    running = np.flatnonzero(scores[:-1] + rest[done] >= floor)
                    self._finish(scores, running, [terms[i] for i in order[done:]])
                    break
        scores = scores[:-1]
        hits = np.flatnonzero(scores > 0)
        if k is not None and len(hits) > k:
            hits = hits[scores[hits] >= self._kth(scores, k) - SLACK]
        return hits, scores[hits]

    @staticmethod
    def _kth(scores: np.ndarray, k: int) -> float:
        return np.partition(scores, -k)[-k] if len(scores) >= k else 0.0

    def _finish(self, scores: np.ndarray, running: np.ndarray, terms: list) -> None:
        shares = self.shares()
        for (lo, hi), weight in terms:
            holds = np.searchsorted(running, self.first[lo:hi]) < np.searchsorted(running, self.last[lo:hi], "right")
            self.skipped += int(hi - lo - holds.sum())
            for b in lo + np.flatnonzero(holds):
                mine = slice(self.start[b], self.start[b + 1])
                at = self.at[mine]
                place = np.minimum(np.searchsorted(running, at), len(running) - 1)
                there = running[place] == at
                scores[at[there]] += weight * shares[mine][there]

    # --- Words ---

    def _of_word(self, terms: Sequence[str], field: str) -> np.ndarray:
        """Records with one of the terms in a field, once each."""
        found = [self.at[self.postings((t, field))] for t in terms if (t, field) in self.rows]
        if not found:
            return np.empty(0, np.int64)
        at = found[0] if len(found) == 1 else np.unique(np.concatenate(found))
        return at[at < len(self.ids)]

    def enough_words(self, words: dict[int, list[str]], fields: Sequence[str], least: int) -> np.ndarray:
        """Records with ``least`` different words in one field."""
        out = np.zeros(len(self.ids), bool)
        for field in fields:
            count = np.zeros(len(self.ids), np.int32)
            for terms in words.values():
                count[self._of_word(terms, field)] += 1
            out |= count >= max(least, 1)
        return np.flatnonzero(out)

    # --- Places of words ---

    def places(self, term: Term) -> np.ndarray:
        """(record, position) of all places of a term in a field, as one ascending number."""
        if not hasattr(self, "_positions"):
            self._positions, self._times = flat(self.blocks["positions"]), flat(self.blocks["tfs"])
            self._begin = np.concatenate([[0], np.cumsum(self._times)])
        mine = self.postings(term)
        at = np.repeat(self.at[mine], self._times[mine])
        return (at << 32) + self._positions[self._begin[mine.start] : self._begin[mine.stop]]

    def phrase(self, words: Sequence[str], field: str) -> np.ndarray:
        """Records where the words follow each other in a field; the rarest word leads."""
        begins: np.ndarray | None = None
        for i in sorted(range(len(words)), key=lambda i: self.postings((words[i], field)).stop - self.postings((words[i], field)).start):
            here = self.places((words[i], field)) - i
            begins = here if begins is None else begins[np.isin(begins, here)]
            if not len(begins):
                break
        at = np.unique(begins >> 32) if begins is not None else np.empty(0, np.int64)
        return at[at < len(self.ids)]

    def gaps(self, lead: Sequence[Term], follow: Sequence[Term], among: np.ndarray) -> np.ndarray:
        """The smallest gap of two words in each record, fields apart: from the nearest earlier
        place of the other word, one more where the follower is the earlier one."""
        best = np.full(len(self.ids) + 1, FAR)
        for field in {f for _, f in lead} & {f for _, f in follow}:
            a, b = (self._sorted_places(side, field, among) for side in (lead, follow))
            for early, late, more in ((a, b, 0), (b, a, 1)):
                if len(early) and len(late):
                    i = np.searchsorted(early, late) - 1
                    before = early[np.maximum(i, 0)]
                    same = (i >= 0) & (before >> 32 == late >> 32)
                    np.minimum.at(best, late[same] >> 32, (late - before)[same] + more)
        return best[among]

    def _sorted_places(self, terms: Sequence[Term], field: str, among: np.ndarray) -> np.ndarray:
        found = np.concatenate([self.places(t) for t in terms if t[1] == field])
        found = found[np.isin(found >> 32, among)]
        return np.unique(found)

    def cascade(self, words: dict[int, list[tuple[str, int, bool]]], n_words: int, fields: Sequence[str], rules: Sequence[str], k: int) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        """Records with a query word and the values of the rank rules.

        ``words`` has (term, typos, by prefix) by word number. The rules ahead of the first
        one that needs a column of the record are applied here: what is behind the k-th
        record by them goes, first by the rules that need no places, then by distance.
        """
        n = len(self.ids)
        found, typos, exact = (np.zeros(n, np.int64) for _ in range(3))
        attribute = np.full(n, len(fields))
        of_word: dict[int, list[Term]] = {}
        for no, terms in words.items():
            least, typed = np.full(n + 1, -1), np.zeros(n + 1, np.int64)
            # Most typos first, so that the fewest is what stays.
            for term, cost, by_prefix in sorted(terms, key=lambda t: -t[1]):
                for rank, field in enumerate(fields):
                    if (term, field) in self.rows:
                        at = self.at[self.postings((term, field))]
                        least[at] = cost
                        typed[at] |= cost == 0 and not by_prefix
                        at = at[at < n]
                        attribute[at] = np.minimum(attribute[at], rank)
                        of_word.setdefault(no, []).append((term, field))
            least, typed = least[:n], typed[:n]
            found += least >= 0
            typos += np.maximum(least, 0)
            exact += typed
        values = {"words": found, "typos": typos, "attribute": attribute, "exactness": exact}
        keys = {"words": -found, "typo": typos, "attribute": attribute, "exactness": -exact}
        hits = np.flatnonzero(found > 0)
        ahead = [r for i, r in enumerate(rules) if all(x in keys or x == "proximity" for x in rules[: i + 1])]
        plain = ahead[: ahead.index("proximity")] if "proximity" in ahead else ahead
        hits = self._cut(hits, [keys[r][hits] for r in plain], k)
        distance = np.zeros(len(hits), np.int64)
        for no in range(n_words - 1):
            both = no in of_word and no + 1 in of_word
            distance += np.minimum(self.gaps(of_word[no], of_word[no + 1], hits), FAR) if both else FAR
        keep = self._cut(np.arange(len(hits)), [distance if r == "proximity" else keys[r][hits] for r in ahead], k)
        out = {c: v[hits[keep]] for c, v in values.items()}
        return hits[keep], out | {"proximity": distance[keep]}

    @staticmethod
    def _cut(hits: np.ndarray, keys: list[np.ndarray], k: int) -> np.ndarray:
        """Hits that are not behind the k-th by ``keys``; all that are level with it stay."""
        if len(hits) <= k or not keys:
            return hits
        order = np.lexsort(keys[::-1])
        last = [key[order[k - 1]] for key in keys]
        behind = np.zeros(len(hits), bool)
        level = np.ones(len(hits), bool)
        for key, value in zip(keys, last, strict=True):
            behind |= level & (key > value)
            level &= key == value
        return hits[~behind]


Found = tuple[object, np.ndarray, dict[str, np.ndarray]]
Search = Callable[[Shard], Iterator[Found]]


def in_shards(
    blocks: DataFrame,
    search: Search,
    qid: T.StructField,
    values: str,
    candidates: DataFrame | None = None,
    means: dict[str, float] | None = None,
) -> DataFrame:
    """``qid``, the candidates' columns (or ``id``) and ``values`` of all that ``search`` finds.

    Both frames have a ``shard``; where they are stored by it, nothing is shuffled.
    """
    carried = [T.StructField("id", T.LongType())]
    if candidates is not None:
        carried = [f for f in candidates.schema.fields if f.name != "shard"]
    kinds = T.StructType.fromDDL(values) if values else T.StructType()
    schema = T.StructType([T.StructField("qid", qid.dataType), *carried, *kinds.fields])
    arrow = to_arrow_schema(schema)

    def run(postings: pa.Table, records: pa.Table | None = None) -> pa.Table:
        shard = Shard(postings, records, means)
        parts = []
        for name, hits, found in search(shard) if postings.num_rows else ():
            if records is None:
                rows, times = [pa.array(shard.ids[hits])], 1
            else:
                # A record in several rows is as many hits.
                times = shard.row[hits + 1] - shard.row[hits]
                first = np.repeat(shard.row[hits] - np.cumsum(times) + times, times)
                at = pa.array(first + np.arange(times.sum()))
                rows = [shard.records[f.name].take(at) for f in carried]
            own = [pa.array(np.repeat(found[f.name], times)) for f in kinds.fields]
            size = len(rows[0])
            parts.append(pa.table([pa.array([name] * size, arrow.field("qid").type), *rows, *own], names=schema.names).cast(arrow))
        return pa.concat_tables(parts) if parts else arrow.empty_table()

    if candidates is None:
        return blocks.groupBy("shard").applyInArrow(lambda t: run(t), schema)
    return blocks.groupBy("shard").cogroup(candidates.groupBy("shard")).applyInArrow(run, schema)


def by_query(rows: Sequence, *columns: str) -> dict[object, list[tuple]]:
    """The rows' columns, listed by query."""
    out: dict[object, list[tuple]] = {}
    for r in rows:
        out.setdefault(r["qid"], []).append(tuple(r[c] for c in columns))
    return out


def with_shard(df: DataFrame, shards: int, id_col: str = "id") -> DataFrame:
    return df if "shard" in df.columns else df.withColumn("shard", F.pmod(F.xxhash64(id_col), F.lit(shards)).cast("int"))
