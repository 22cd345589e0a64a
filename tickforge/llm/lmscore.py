"""Cross-entropy difference of two matched n-gram models, after Moore and Lewis.

Words are lower-cased (A-Z) and hashed. Both models share one vocabulary, all words of the
corpus, and all bigrams have counts of their own, mixed with those of their second word. The
models are matched: the background's counts are weighed down to as many words as the target
has before they are smoothed. Counts are taken over all documents, target and background side
by side.

Documents are dealt to blocks of some megabytes of text. A block sends its distinct words and
bigrams, 64-bit hashes, with its counts to shares of the hashes, whose number follows the
corpus. A share adds them up over all blocks and answers each block with the corpus's counts
in the order of its own hashes, so that these need not go back. With the answers a block
scores its documents. No key is hot, as a block names each word and bigram once, and nothing
is broadcast. Losses are added up in fixed point, in any order.

``train`` gives models of the frequent words and bigrams alone, with which texts from
elsewhere can be scored without the corpus.

score = mean over tokens of -log p_target + log p_background: the lower, the more a document
resembles the target.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickforge.llm.common import Scratch, in_slices, let_go, pick
from tickforge.llm.shingles import mix, word_hashes
from tickforge.session import session_conf

WORD_SHARE = 1e-5
BIGRAM_SHARE = 1e-6
#: Weight of a bigram's own frequency.
BLEND = 0.7
#: Keys a task gathers before it adds them up.
GATHERED = 1 << 20

START, UNKNOWN = 0, 1  # ids; words follow
#: Fixed point of summed losses.
FIXED = 1 << 32

#: Bytes of text in a block, but for longer texts, and for which there is a share of the hashes.
BLOCK_BYTES = 1 << 23
SHARE_BYTES = 1 << 23
#: Shuffled files go as soon as what they were for is written, and texts are written small.
SAVING = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}


def _counted(keys_of):
    """(key, n, t): occurrences in all documents and in target documents, by task."""

    def run(batches: Iterator[pa.RecordBatch]):
        held, size = ([], []), 0
        total = None

        def added(total):
            sums = []
            for part in held:
                if part:
                    sums.append(np.unique(np.concatenate(part), return_counts=True))
                else:
                    sums.append((np.zeros(0, np.int64), np.zeros(0, np.int64)))
            (ka, ca), (kt, ct) = sums
            rows = [(ka, ca, np.zeros_like(ca)), (kt, ct, ct)] + ([total] if total else [])
            keys = np.concatenate([r[0] for r in rows])
            uniq, place = np.unique(keys, return_inverse=True)
            n = np.bincount(place, np.concatenate([r[1] for r in rows]), len(uniq))
            t = np.bincount(place, np.concatenate([r[2] for r in rows]), len(uniq))
            return uniq, n.astype(np.int64), t.astype(np.int64)

        def batch_of(total):
            return pa.RecordBatch.from_arrays(list(map(pa.array, total)), names=["key", "n", "t"])

        for batch in batches:
            for text, target in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                keys = keys_of(text)
                held[bool(target)].append(keys)
                size += len(keys)
            if size >= GATHERED:
                total, held, size = added(total), ([], []), 0
                if len(total[0]) >= GATHERED:
                    yield batch_of(total)
                    total = None
        total = added(total)
        if len(total[0]):
            yield batch_of(total)

    return run


def _sums(docs, keys_of):
    found = docs.select("text", "target").mapInArrow(
        in_slices(_counted(keys_of)), "key bigint, n bigint, t bigint"
    )
    return found.groupBy("key").agg(F.sum("n").alias("n"), F.sum("t").alias("t"))


def _words(text):
    return word_hashes(text).view(np.int64)


class Models:
    """Both models as sorted arrays: of word hashes, and of bigram keys."""

    def __init__(self, words, n, t, total, total_t):
        order = np.argsort(words)
        self.words, counts = words[order], [n[order], t[order]]
        self.size = len(words) + 2
        self.bigrams = np.zeros(0, np.int64)
        self.unigram, self.follows = [], []
        matched = total_t / total if total_t else 1.0
        for own, whole, weight in zip(counts, (total, total_t), (matched, 1.0)):
            all_ids = np.concatenate([[0, max(whole - own.sum(), 0)], own]).astype(float)
            self.unigram.append((weight * all_ids + 1) / (weight * all_ids.sum() + self.size - 1))
            self.follows.append(all_ids)

    def ids(self, text):
        found = _words(text)
        if not len(self.words):
            return np.full(len(found), UNKNOWN)
        place = np.minimum(np.searchsorted(self.words, found), len(self.words) - 1)
        return np.where(self.words[place] == found, place + 2, UNKNOWN)

    def keys(self, text):
        ids = self.ids(text)
        before = np.concatenate([[START], ids[:-1]]) if len(ids) else ids
        return (before * self.size + ids).astype(np.int64)

    def learn(self, keys, n, t, documents, documents_t):
        order = np.argsort(keys)
        self.bigrams = keys[order]
        ids, before = self.bigrams % self.size, self.bigrams // self.size
        self.losses, self.fallback, self.stay = [], [], []
        for counts, unigram, follows, starts in zip(
            (n[order], t[order]), self.unigram, self.follows, (documents, documents_t)
        ):
            context = follows.copy()
            context[START] = starts
            # A context that the model has not seen leaves all weight to the unigram.
            blend = np.where(context > 0, BLEND, 0.0)
            own = blend[before] * counts / np.maximum(context[before], 1)
            self.losses.append(-np.log(own + (1 - blend[before]) * unigram[ids]))
            self.fallback.append(-np.log(unigram))
            self.stay.append(-np.log(1 - blend))

    def score(self, text):
        """(tokens, target loss, background loss): mean negative log-likelihoods."""
        keys = self.keys(text)
        if not len(keys):
            return 0, None, None
        ids, before = keys % self.size, keys // self.size
        if len(self.bigrams):
            place = np.minimum(np.searchsorted(self.bigrams, keys), len(self.bigrams) - 1)
            known = self.bigrams[place] == keys
        else:
            place, known = ids, np.zeros(len(ids), bool)
        means = []
        for losses, fallback, stay in zip(self.losses, self.fallback, self.stay):
            lone = fallback[ids] + stay[before]
            means.append(float((np.where(known, losses[place], lone) if known.any() else lone).mean()))
        return len(keys), means[1], means[0]


def _often(share, total, total_t):
    """Keys with their share of the corpus or of the target, of which there are 2 / share at most."""
    enough = (F.col("n") >= share * total) & (F.col("n") > 0)
    return enough | (F.col("t") >= share * total_t) & (F.col("t") > 0)


def train(docs: DataFrame, word_share=WORD_SHARE, bigram_share=BIGRAM_SHARE) -> Models:
    """Models from (text, target). What the driver gets is bounded by the two shares."""
    with Scratch(docs.sparkSession, "lmscore") as scratch:
        words = scratch.keep(_sums(docs, _words))
        total, total_t, = words.agg(F.sum("n"), F.sum("t")).first()
        total, total_t = int(total or 0), int(total_t or 0)
        often = words.where(_often(word_share, total, total_t)).toPandas()
        models = Models(*(often[c].to_numpy(np.int64) for c in ("key", "n", "t")), total, total_t)
        sent = docs.sparkSession.sparkContext.broadcast(models)
        pairs = _sums(docs, lambda text: sent.value.keys(text))
        often = pairs.where(_often(bigram_share, total, total_t)).toPandas()
        some = docs.where("text is not null").agg(
            F.count("*"), F.sum(F.col("target").cast("int"))
        ).first()
        models.learn(
            *(often[c].to_numpy(np.int64) for c in ("key", "n", "t")), some[0], some[1] or 0
        )
        return models


def cross_entropy_difference(
    df: DataFrame, target_ids: DataFrame, doc_id="doc_id", text="text"
) -> DataFrame:
    """Per row: doc_id, n_tokens, target_loss, background_loss, score (their difference).

    ``target_ids`` has the doc_ids whose texts make up the target model; the background is
    all documents. Documents are scored whole, those of the target included. Null and empty
    texts have no tokens and null losses; a null id is never a target; repeated rows count
    as often as they stand, repeated target ids once. With no target documents the target
    model is uniform over the vocabulary. Every word and bigram of the documents counts.
    """
    docs = pick(df, doc_id=doc_id, text=text).withColumn("doc_id", F.col("doc_id").cast("long"))
    marks = target_ids.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    spark = df.sparkSession
    with Scratch(spark, "lmscore") as scratch, session_conf(spark, SAVING):
        # Target ids grow with the corpus: a shuffle at every size, never a broadcast.
        marks = marks.withColumn("target", F.lit(True)).hint("merge")
        marked = docs.join(marks, "doc_id", "left").select(
            "doc_id", "text", F.coalesce("target", F.lit(False)).alias("target")
        )
        blocks = scratch.keep(marked.mapInArrow(in_slices(_blocks(BLOCK_BYTES)), BLOCKS))
        size, *starts = blocks.agg(
            F.sum("size"), F.count("size"), F.count_if(F.expr("target and size is not null"))
        ).first()
        shares = (size or 0) // SHARE_BYTES + 1
        counts = blocks.select("block", "place", "text", "target").mapInArrow(
            in_slices(_counts(shares)), COUNTS
        )
        answers = scratch.keep(counts.groupBy("kind", "share").applyInArrow(_answers, ANSWERS))
        totals = answers.where(f"kind = {WORD}").agg(
            *[F.coalesce(F.sum(c), F.lit(0)) for c in ("distinct", "total", "total_t")]
        ).first()
        asking = blocks.select("block", "place", "doc_id", "text").groupBy("block")
        answered = answers.select("block", "start", "kind", "share", "n", "t").groupBy("block")
        losses = _losses(starts, *totals)
        scored = scratch.keep(asking.cogroup(answered).applyInArrow(losses, LOSSES), last=True)
    return scored.withColumn("score", F.col("target_loss") - F.col("background_loss"))


#: Rows with the block they are in, their place there, and their bytes (null: no text).
BLOCKS = "block bigint, place bigint, doc_id bigint, text string, target boolean, size bigint"
#: Of the rows of a block from place ``start`` on: the hashes of a kind in a share, ascending,
#: with their occurrences and those in target documents.
COUNTS = "block bigint, start bigint, kind int, share int, keys array<bigint>, n array<int>, t array<int>"
#: The same hashes' counts in the corpus, and, once a share, how many hashes and occurrences
#: it has.
ANSWERS = (
    "block bigint, start bigint, kind int, share int, n array<bigint>, t array<bigint>, "
    "distinct bigint, total bigint, total_t bigint"
)
LOSSES = "doc_id bigint, n_tokens bigint, target_loss double, background_loss double"

WORD, BIGRAM = 0, 1


def _blocks(most):
    """Deal (doc_id, text, target) to blocks of ``most`` bytes, in the order in which rows come."""

    def run(batches: Iterator[pa.RecordBatch]):
        block, place, filled = TaskContext.get().partitionId() << 32, 0, 0
        for batch in batches:
            sizes, dealt, places = pc.binary_length(batch.column(1)), [], []
            for size in sizes.to_pylist():
                size = 64 + (size or 0)  # empty rows take memory, too
                if place and filled + size > most:
                    block, place, filled = block + 1, 0, 0
                dealt.append(block)
                places.append(place)
                place, filled = place + 1, filled + size
            yield pa.RecordBatch.from_arrays(
                [pa.array(dealt, pa.int64()), pa.array(places, pa.int64()), *batch.columns, sizes.cast(pa.int64())],
                names=["block", "place", "doc_id", "text", "target", "size"],
            )

    return run


class _Bigrams:
    """The words and bigrams of some texts, and the distinct ones among them.

    ``words`` and ``keys`` have the distinct hashes, ascending; ``word`` and ``key`` say which
    of them stands at each token, and ``before`` which word comes before the first occurrence
    of each distinct bigram (beyond all words: none).
    """

    def __init__(self, texts):
        found = [word_hashes(text) for text in texts]
        self.lengths = np.array([len(x) for x in found], np.int64)
        self.ends = np.cumsum(self.lengths)
        words = np.concatenate([np.zeros(0, np.uint64), *found])
        del found
        firsts = (self.ends - self.lengths)[self.lengths > 0]
        self.words, self.word = np.unique(words, return_inverse=True)
        before = np.roll(words, 1)
        before[firsts] = START
        words += mix(before)
        self.keys, first, self.key = np.unique(mix(words), return_index=True, return_inverse=True)
        places = np.roll(self.word, 1)
        places[firsts] = len(self.words)
        self.before, self.after = places[first], self.word[first]


def _counts(shares):
    """Counts of the words and bigrams of each run of rows of a block."""
    # Shares are even ranges of the hashes.
    edges = np.array([(k << 64) // shares for k in range(1, shares)], np.uint64)

    def run(batches: Iterator[pa.RecordBatch]):
        held, at = [], None

        def counted():
            found = _Bigrams([text for text, _ in held])
            target = np.repeat([bool(x) for _, x in held], found.lengths)
            for kind, keys, place in ((WORD, found.words, found.word), (BIGRAM, found.keys, found.key)):
                offsets = np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]]).astype(np.int32)
                some = np.flatnonzero(np.diff(offsets))
                if not len(some):
                    continue
                n = np.bincount(place, minlength=len(keys)).astype(np.int32)
                t = np.bincount(place, target, len(keys)).astype(np.int32)
                # Empty shares have no part of the values.
                lists = [
                    pa.ListArray.from_arrays(np.append(offsets[some], offsets[-1]), pa.array(x))
                    for x in (keys.view(np.int64), n, t)
                ]
                same = [pa.array(np.full(len(some), x), pa.int64()) for x in (at[0], at[1] - len(held))]
                kinds = pa.array(np.full(len(some), kind), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [*same, kinds, pa.array(some, pa.int32()), *lists],
                    names=["block", "start", "kind", "share", "keys", "n", "t"],
                )

        for batch in batches:
            for block, place, text, target in zip(*[c.to_pylist() for c in batch.columns]):
                if held and (block, place) != at:  # the next block, or a file that was split
                    yield from counted()
                    held = []
                held.append((text, target))
                at = block, place + 1
        if held:
            yield from counted()

    return run


def _flat(table, column):
    """(values, offsets) of a column of lists."""
    lists = table.column(column).combine_chunks()
    offsets = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))])
    return lists.flatten().to_numpy(zero_copy_only=False), offsets.astype(np.int32)


def _answers(table: pa.Table) -> pa.Table:
    """What a share has counted, to each block in the order in which it asked."""
    let_go(__name__)
    keys, offsets = _flat(table, "keys")
    distinct, place = np.unique(keys, return_inverse=True)
    n, t = (
        np.bincount(place, _flat(table, c)[0], len(distinct)).astype(np.int64) for c in ("n", "t")
    )
    lists = [pa.ListArray.from_arrays(offsets, pa.array(x[place], pa.int64())) for x in (n, t)]
    sums = [
        pa.array([x, *[0] * (table.num_rows - 1)], pa.int64())
        for x in (len(distinct), int(n.sum()), int(t.sum()))
    ]
    columns = [table.column(c) for c in ("block", "start", "kind", "share")]
    return pa.Table.from_arrays(
        [*columns, *lists, *sums],
        names=["block", "start", "kind", "share", "n", "t", "distinct", "total", "total_t"],
    )


def _losses(starts, distinct, total, total_t):
    """Losses of a block's rows, from the rows and the answers to the block."""
    matched = total_t / total if total_t else 1.0

    def loss(count, context, single, whole, weight):
        single = (weight * single + 1) / (weight * whole + (distinct + 1))
        blend = np.where(context > 0, BLEND, 0.0)
        mixed = blend * count / np.maximum(context, 1) + (1 - blend) * single
        return np.floor(-np.log(mixed) * FIXED + 0.5).astype(np.int64)

    def run_losses(texts, answers):
        """(tokens, target loss, background loss) of texts that were counted together."""
        found = _Bigrams(texts)
        answers = answers.sort_by([("kind", "ascending"), ("share", "ascending")])
        counts = {}
        for column in ("t", "n"):
            for kind, keys in ((WORD, found.words), (BIGRAM, found.keys)):
                own = answers.filter(pc.equal(answers.column("kind"), kind))
                counts[column, kind] = _flat(own, column)[0] if own.num_rows else np.zeros(0, np.int64)
                if len(counts[column, kind]) != len(keys):
                    raise ValueError("a block has other words than were counted")
        sums = []
        for column, start, whole, weight in (("t", starts[1], total_t, 1.0), ("n", starts[0], total, matched)):
            words = counts[column, WORD]
            context = np.append(words, start)[found.before]
            each = loss(counts[column, BIGRAM], context, words[found.after], whole, weight)
            along = np.concatenate([[0], np.cumsum(each[found.key])])
            sums.append(along[found.ends] - along[found.ends - found.lengths])
        return found.lengths, *sums

    def scored(rows: pa.Table, answers: pa.Table) -> pa.Table:
        let_go(__name__)
        rows = rows.sort_by("place")
        texts, places = rows.column("text").to_pylist(), rows.column("place").to_numpy()
        given = answers.column("start").to_numpy()
        edges = [*np.searchsorted(places, np.unique(given)).tolist(), len(texts)]
        columns = [np.zeros(len(texts), np.int64) for _ in range(3)]
        for first, end in zip(edges, edges[1:]):
            own = answers.filter(pa.array(given == places[first]))
            for column, x in zip(columns, run_losses(texts[first:end], own)):
                column[first:end] = x
        n, *sums = columns
        means = [pa.array(x / FIXED / np.maximum(n, 1), mask=n == 0) for x in sums]
        return pa.Table.from_arrays(
            [rows.column("doc_id"), pa.array(n), *means],
            names=["doc_id", "n_tokens", "target_loss", "background_loss"],
        )

    return scored
