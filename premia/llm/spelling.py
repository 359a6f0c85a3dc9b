"""Spelling variants: words one letter apart, found in a trie over letter-group counts.

A word is its vector of letter-group counts (code point modulo the number of groups). Words one inserted, deleted or replaced
letter apart have vectors with at most one count too many and one too few. The counts of ``COARSE`` groups are the top of the trie, and serve as
the key by which Spark deals the words to tasks: a word is an entry of the node of its own counts, and a question to the nodes that
a budget of one surplus and one deficit reaches. Of the two words of a pair only one asks: the longer one, else the one with the greater
counts, else the greater word. Nodes with more than ``SHARD`` words are split by hash, and questions go to all splits.
In a task, the words of one split make the rest of the trie, by ``FINE`` groups; a depth-first search spends what
the budget allows, and the words of the leaves it reaches are verified letter by letter. Questions are streamed, so a task holds one split.

Defined results: a null text has no words; a null doc_id counts as the empty text in the hash of a run; repeated rows count again; ties
between near words of equal count go to the smallest in code-point order; a word without near words is its own root. Very long texts and words are
taken whole. An empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from premia.llm.common import documents, written

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {c: c + 32 for c in range(65, 91)}
#: Letter groups of the top of the trie, which are the keys that words are dealt by, and of the trie in a task. The second is a multiple of the first.
COARSE, FINE = 6, 24
#: Words of a split, about, and words of a leaf that is not split further.
SHARD, LEAF = 20_000, 6
#: Different words that a task counts before it passes them on.
HELD = 300_000


def lowered(run: str) -> str:
    return run.lower() if run.isascii() else run.translate(LOWER)


def _counted(modulus: int, least_chars: int):
    # Shorter runs are no words, and skipping them changes no other run.
    find = re.compile(RUN.pattern[:-1] + f"{{{least_chars},}}").findall

    def run(batches):
        total: dict = {}
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for raw, n in Counter(find(text.as_py() or "")).items():
                    word = lowered(raw)
                    h = zlib.crc32(word.encode(), start)
                    if not h % modulus:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < least_chars:
                            continue
                    total[word] = total.get(word, 0) + n
                if len(total) > HELD:
                    yield _table(total)
                    total = {}
        yield _table(total)

    return run


def _table(total: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"word": pa.array(total.keys(), pa.string()), "n": pa.array(total.values(), pa.int64())})


def vocabulary(docs: DataFrame, least_chars: int = 6, least_n: int = 5, modulus: int = 199) -> DataFrame:
    """word and n: the words of at least ``least_chars`` code points with at least ``least_n`` occurrences in all texts."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counts = rows.mapInArrow(_counted(modulus, least_chars), "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_n)


def vector(word: str, groups: int) -> list:
    counts = [0] * groups
    for c in word:
        counts[ord(c) % groups] += 1
    return counts


def reachable(counts: list) -> list:
    """Vectors of the nodes that a word with these counts asks, besides its own."""
    out = []
    for i, c in enumerate(counts):
        if c:
            less = [*counts[:i], c - 1, *counts[i + 1 :]]
            out.append(less)  # a letter fewer
            out += [[*less[:j], less[j] + 1, *less[j + 1 :]] for j in range(i + 1, len(counts))]  # a letter replaced
    return out


#: What a row is to the node it is dealt to: an entry, a question to its own node, a question to another one.
ENTRY, OWN, OTHER = 0, 1, 2


def _dealt(batches):
    for batch in batches:
        out = {"node": [], "role": [], "word": [], "n": []}
        for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist()):
            counts = vector(word, COARSE)
            nodes = [counts, counts, *reachable(counts)]
            out["node"] += [",".join(map(str, x)) for x in nodes]
            out["role"] += [ENTRY, OWN] + [OTHER] * (len(nodes) - 2)
            out["word"] += [word] * len(nodes)
            out["n"] += [n] * len(nodes)
        yield pa.RecordBatch.from_pydict({k: pa.array(v, t) for (k, v), t in zip(out.items(), (pa.string(), pa.int32(), pa.string(), pa.int64()))})


class Trie:
    """Words of one length by the counts of successive letter groups. A node is a dictionary from a count to the next node, or a list of words."""

    def __init__(self, entries: list):
        self.length = len(entries[0][0])
        self.root = self.node([(vector(w, FINE), w, n) for w, n in entries], 0)

    def node(self, entries: list, depth: int):
        if len(entries) <= LEAF or depth == FINE:
            return [(w, n) for _, w, n in entries]
        parts: dict = {}
        for e in entries:
            parts.setdefault(e[0][depth], []).append(e)
        return {c: self.node(part, depth + 1) for c, part in parts.items()}

    def near(self, word: str):
        """Entries (word, n) one letter away: replaced where they have the length of ``word``, else one letter fewer."""
        counts, same = vector(word, FINE), len(word) == self.length
        stack = [(self.root, 0, same, True)]
        while stack:
            node, depth, surplus, deficit = stack.pop()
            if type(node) is list:
                for entry in node:
                    if (replaced if same else shortened)(word, entry[0]):
                        yield entry
                continue
            c = counts[depth]
            if (child := node.get(c)) is not None:
                stack.append((child, depth + 1, surplus, deficit))
            if surplus and (child := node.get(c + 1)) is not None:
                stack.append((child, depth + 1, False, deficit))
            if deficit and (child := node.get(c - 1)) is not None:
                stack.append((child, depth + 1, surplus, False))


def replaced(a: str, b: str) -> bool:
    """Exactly one letter of two words of one length differs."""
    for i, (x, y) in enumerate(zip(a, b)):
        if x != y:
            return a[i + 1 :] == b[i + 1 :]
    return False


def shortened(a: str, b: str) -> bool:
    """``b`` is ``a`` without one letter."""
    for i, (x, y) in enumerate(zip(a, b)):
        if x != y:
            return a[i + 1 :] == b[i:]
    return True


def _search(batches):
    """Pairs of near words. The rows of a split are together, its entries first."""
    split, entries, trie = None, [], None
    for batch in batches:
        out = {"word": [], "n": [], "near": [], "near_n": []}
        for node, part, role, word, n in zip(*[batch.column(c).to_pylist() for c in ("node", "part", "role", "word", "n")]):
            if (node, part) != split:
                split, entries, trie = (node, part), [], None
            if role == ENTRY:
                entries.append((word, n))
                continue
            if not entries:
                continue
            trie = trie or Trie(entries)
            for other, other_n in trie.near(word):
                if role == OTHER or other < word:
                    for row in ((word, n, other, other_n), (other, other_n, word, n)):
                        for k, v in zip(out, row):
                            out[k].append(v)
        yield pa.RecordBatch.from_pydict({k: pa.array(v, t) for (k, v), t in zip(out.items(), (pa.string(), pa.int64()) * 2)})


def near_words(words: DataFrame, shard: int = SHARD) -> DataFrame:
    """word, n, near, near_n: each pair of near words, in both orders. ``words`` has word and n, one row per word, and is read twice: write it first."""
    dealt = words.select("word", "n").mapInArrow(_dealt, "node string, role int, word string, n long")
    entries, questions = dealt.filter(F.col("role") == ENTRY), dealt.filter(F.col("role") != ENTRY)
    sizes = entries.groupBy("node").agg(F.ceil(F.count(F.lit(1)) / F.lit(shard)).cast("int").alias("parts"))
    entries = entries.join(sizes, "node").withColumn("part", F.pmod(F.xxhash64("word"), "parts").cast("int"))
    questions = questions.join(sizes, "node").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    columns = ("node", "part", "role", "word", "n")
    rows = entries.select(*columns).unionAll(questions.select(*columns))
    spread = rows.repartition(int(words.sparkSession.conf.get("spark.sql.shuffle.partitions")), "node", "part")
    return spread.sortWithinPartitions("node", "part", "role").mapInArrow(_search, "word string, n long, near string, near_n long")


def roots(forms: DataFrame, longest: int) -> DataFrame:
    """word and root from word and form (no nulls, no cycles): where the chain of forms ends, for chains of up to ``longest`` forms.

    Each round doubles the part of the chain that is behind a word.
    """
    ends, reach = forms.select("word", F.col("form").alias("root")), 1
    while reach < longest:
        ends = written(ends, "roots")
        further = ends.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        ends = ends.join(further, "root", "left").select("word", F.coalesce("_next", "root").alias("root"))
        reach *= 2
    return ends


def variants(words: DataFrame, ratio: int = 5, shard: int = SHARD) -> DataFrame:
    """word, n, n_near, form, form_n, root of every word of ``words`` (word, n), a written table."""
    best = F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("word"))).alias("best")
    near = near_words(words, shard).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    found = words.join(near, "word", "left").withColumn("_n", -F.col("best.n"))
    is_form = F.col("_n") >= F.col("n") * ratio
    found = written(
        found.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(is_form, F.col("best.word")).alias("form"), F.when(is_form, F.col("_n")).alias("form_n"),
        ),
        "forms",
    )
    # A form is at least ``ratio`` times as frequent, which bounds the chains. One row.
    span = found.agg(F.max("n").alias("most"), F.min("n").alias("least")).first()
    longest = 0
    while span["most"] and span["least"] * ratio ** (longest + 1) <= span["most"]:
        longest += 1
    ends = roots(found.filter(F.col("form").isNotNull()), longest)
    return found.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = written(vocabulary(documents(spark, sf_dir)), "words")
    return variants(words).select("word", "form", "root", "n", "n_near", "form_n")


ORACLE = r"""
WITH RECURSIVE
crc AS (
    SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, x: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) ORDER BY i) AS t
    FROM range(256) r(i)
),
runs AS (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents),
low AS (
    SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
    FROM runs WHERE length(run) >= 6 GROUP BY ALL
),
bytes AS (SELECT *, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS x FROM low),
hashed AS (
    SELECT run, n, xor(list_reduce([4294967295] || list_transform(range(1, length(x), 2), lambda i: ('0x' || substr(x, i, 2))::BIGINT),
        lambda a, b: xor(a >> 8, crc.t[(xor(a, b) & 255) + 1])), 4294967295) AS h
    FROM bytes, crc
),
words AS (
    SELECT CASE WHEN h % 199 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, sum(n)::BIGINT AS n
    FROM hashed GROUP BY word HAVING length(word) >= 6 AND sum(n) >= 5
),
cut AS (SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest FROM words, range(1, length(word) + 1) r(i)),
pairs AS (
    SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
    UNION SELECT a.word, a.n, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
    UNION SELECT b.word, b.n, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word
),
best AS (SELECT word, n, near, near_n, count(*) OVER w AS n_near, row_number() OVER (w ORDER BY near_n DESC, near) AS nth FROM pairs WINDOW w AS (PARTITION BY word)),
forms AS (
    SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.near_n >= 5 * w.n THEN b.near END AS form, CASE WHEN b.near_n >= 5 * w.n THEN b.near_n END AS form_n
    FROM words w LEFT JOIN best b ON b.word = w.word AND b.nth = 1
),
chain AS (
    SELECT word, word AS root, form AS next FROM forms
    UNION ALL SELECT c.word, f.word, f.form FROM chain c JOIN forms f ON f.word = c.next
)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n FROM forms f JOIN chain c ON c.word = f.word AND c.next IS NULL
"""
