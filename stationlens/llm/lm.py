"""Language-model scoring with a causal self-attention model on subword ids.

Words (lower-cased A-Z) are split into subwords of a public byte-level vocabulary. The model
predicts the next subword from up to 31 before it: one attention head over token and position
vectors, on top of the next-subword statistics of the whole training corpus, which come from the
word counts. The softmax has two levels, 32 groups of 32 subwords: the 1,022 most frequent ones,
the end of the text, and one place for all others, which share its probability by their counts in
the training corpus; those never seen have the weight of those seen once between them.

A text is cut into blocks of 16 subwords. Each window is a block and the one before it; only the
block's own subwords are scored, so windows overlap and every subword is scored once. Windows are
evaluated in batches under a causal mask.

What all texts are measured against, the counts of training words, covers all training rows and
never leaves Spark as a whole: at most ``HEAD`` of the most frequent words of up to 64 bytes go to
the tasks, all other words meet their counts in a join. The attention head learns from all blocks of
all training rows, in each task from its own, and is the mean over the tasks.

Defined cases: null and empty texts consist of the end alone; without training rows every count
is 0 and the model knows nothing; rows that repeat an id are scored on their own.
"""

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlens.llm import words as W
from stationlens.session import checkpointed

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
FOLDER = "/opt/tokenizers"
HEAD = 1 << 17
HEAD_BYTES = 64
BLOCK = 16
D = 16
GROUPS = 32
SIZE = GROUPS * GROUPS
END, OTHER, PAD = 0, 1, SIZE
ROWS = 8 * SIZE
BATCH_BLOCKS = 4096
_CODERS = {}


def coder(folder: str = FOLDER, name: str = VOCABULARY):
    """(subword coder, True for the ids that begin with a space) of a public vocabulary file."""
    if (folder, name) not in _CODERS:
        import public_tokenizers
        import tiktoken

        with open(f"{folder}/{name}", "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        opens = np.zeros(max(ranks.values()) + 2, bool)
        opens[[v for k, v in ranks.items() if k[:1] == b" "]] = True
        _CODERS[folder, name] = tiktoken.Encoding("subwords", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}), opens
    return _CODERS[folder, name]


def subwords(vocab: pa.Array, folder: str = FOLDER):
    """(ids, first id of each word) of distinct words, each coded with a space before it."""
    enc, opens = coder(folder)
    known = vocab.to_pylist()
    ids, at = [], [0]
    for s in range(0, len(known), 20_000):
        text = "".join(" " + w.decode("utf-8", "replace") for w in known[s : s + 20_000])
        part = np.array(enc.encode_ordinary(text), np.int64)
        begin = np.flatnonzero(opens[part])
        if len(begin) == len(known[s : s + 20_000]):
            ids.append(part)
            at.extend((begin[1:] + sum(map(len, ids[:-1]))).tolist() + [sum(map(len, ids))])
        else:  # other kinds of space inside words join or split pieces; such groups are coded word by word
            for w in known[s : s + 20_000]:
                ids.append(np.array(enc.encode_ordinary(" " + w.decode("utf-8", "replace")), np.int64))
                at.append(at[-1] + len(ids[-1]))
    return (np.concatenate(ids) if ids else np.zeros(0, np.int64)), np.array(at, np.int64)


def spread(lengths, first):
    """Positions first[i], first[i] + 1, ... for each run of ``lengths``, in order."""
    total = int(lengths.sum())
    begin = np.cumsum(lengths) - lengths
    return np.arange(total) - np.repeat(begin - first, lengths)


# Counts over the whole corpus


def count_words(docs: DataFrame) -> DataFrame:
    """(word, c): counts of all words of all rows; the empty word stands for the ends."""

    def tally(batches):
        total, ends = {}, 0
        for batch in batches:
            ends += batch.num_rows
            for data, off in W.slices(batch.column(0)):
                w = W.split_words(data, off)
                for k, n in zip(w.vocab.to_pylist(), np.bincount(w.codes, minlength=len(w.vocab)).tolist()):
                    total[k] = total.get(k, 0) + n
                if len(total) > 400_000:
                    yield _counted(total)
                    total = {}
        total[b""] = total.get(b"", 0) + ends
        yield _counted(total)

    return docs.select("text").mapInArrow(tally, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c")).filter("c > 0")


def _counted(total):
    return pa.RecordBatch.from_arrays([pa.array(list(total), pa.binary()), pa.array(list(total.values()), pa.int64())], ["word", "c"])


def subword_counts(counts: DataFrame, folder: str = FOLDER) -> np.ndarray:
    """Occurrences of each subword id in the counted corpus (as many numbers as the vocabulary has)."""

    def tally(batches):
        total = np.zeros(len(coder(folder)[1]), np.int64)
        for batch in batches:
            ids, at = subwords(batch.column(0), folder)
            c = batch.column(1).to_numpy(zero_copy_only=False)
            np.add.at(total, ids, np.repeat(c, np.diff(at)))
        live = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(live, pa.int32()), pa.array(total[live])], ["i", "n"])

    out = np.zeros(len(coder(folder)[1]), np.int64)
    found = counts.filter("length(word) > 0").mapInArrow(tally, "i int, n long").groupBy("i").agg(F.sum("n").alias("n")).toArrow()
    out[found.column("i").to_numpy()] = found.column("n").to_numpy()
    return out


def prefix_hashes(ids: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Hash of each word's subwords up to and including each one, 0 for the first of a word."""
    place = np.arange(len(ids)) - np.repeat(at[:-1], np.diff(at))
    out = np.zeros(len(ids), np.uint64)
    last = ids.astype(np.uint64) + np.uint64(1)
    for k in range(1, int(place.max()) + 1 if len(place) else 0):
        here = np.flatnonzero(place == k)
        grown = (last[here - 1] ^ (last[here] * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xBF58476D1CE4E5B9)
        last[here] = grown ^ (grown >> np.uint64(31))
        out[here] = last[here]
    return out


def common_prefixes(counts: DataFrame, folder: str = FOLDER) -> np.ndarray:
    """The hashes of the ``ROWS - SIZE`` most frequent beginnings of two or more subwords, sorted."""

    def tally(batches):
        total = {}
        for batch in batches:
            ids, at = subwords(batch.column(0), folder)
            h = prefix_hashes(ids, at)
            key, inverse = np.unique(h[h > 0], return_inverse=True)
            n = np.bincount(inverse, np.repeat(batch.column(1).to_numpy(zero_copy_only=False), np.diff(at))[h > 0])
            for k, v in zip(key.view(np.int64).tolist(), n.astype(np.int64).tolist()):
                total[k] = total.get(k, 0) + v
            if len(total) > 400_000:
                yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.int64())], ["h", "n"])
                total = {}
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.int64())], ["h", "n"])

    sums = counts.filter("length(word) > 0").mapInArrow(tally, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    # As Arrow, because a collected top list would bring one from each partition to the driver.
    return np.sort(sums.orderBy(F.desc("n"), "h").limit(ROWS - SIZE).toArrow().column("h").to_numpy().astype(np.int64).view(np.uint64))


def rows_of(ids: np.ndarray, at: np.ndarray, places: np.ndarray, prefixes: np.ndarray) -> np.ndarray:
    """The row of statistics after each subword: that of the word's beginning if it is common, else that of the subword."""
    out = places[ids].copy()
    if len(prefixes):
        h = prefix_hashes(ids, at)
        k = np.minimum(np.searchsorted(prefixes, h), len(prefixes) - 1)
        hit = (prefixes[k] == h) & (h > 0)
        out[hit] = SIZE + k[hit]
    return out


def transitions(counts: DataFrame, places: np.ndarray, prefixes: np.ndarray, folder: str = FOLDER) -> tuple:
    """(SIZE x SIZE, ROWS x SIZE) counts of next places inside words after each place and after each row; the row END counts first and the column END last subwords."""

    def tally(batches):
        total = {}
        for batch in batches:
            ids, at = subwords(batch.column(0), folder)
            c = batch.column(1).to_numpy(zero_copy_only=False)
            p, row = places[ids], rows_of(ids, at, places, prefixes)
            last = np.zeros(len(ids), bool)
            last[at[1:] - 1] = True
            own, then = np.repeat(c, np.diff(at)), np.where(last, END, np.append(p[1:], END))
            deep = row >= SIZE
            pair = np.concatenate([p * SIZE + then, p[at[:-1]], row[deep] * SIZE + then[deep]])
            n = np.concatenate([own, c, own[deep]])
            key, inverse = np.unique(pair, return_inverse=True)
            for k, v in zip(key.tolist(), np.bincount(inverse, n).astype(np.int64).tolist()):
                total[k] = total.get(k, 0) + v
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(list(total.values()), pa.int64())], ["i", "n"])

    out = np.zeros(ROWS * SIZE, np.float32)
    sums = checkpointed(counts.filter("length(word) > 0").mapInArrow(tally, "i int, n long").groupBy("i").agg(F.sum("n").alias("n")))
    for low in range(0, ROWS * SIZE, SIZE * SIZE):  # a part of the rows at a time
        found = sums.filter((F.col("i") >= low) & (F.col("i") < low + SIZE * SIZE)).toArrow()
        out[found.column("i").to_numpy()] = found.column("n").to_numpy()
    return out.reshape(ROWS, SIZE)[:SIZE].astype(float), out.reshape(ROWS, SIZE)


def last_places(counts: DataFrame, places: np.ndarray, prefixes: np.ndarray, folder: str = FOLDER) -> np.ndarray:
    """The place of the last subword of each row's beginning (its own for the rows of places)."""

    def tally(batches):
        seen = {}
        for batch in batches:
            ids, at = subwords(batch.column(0), folder)
            row = rows_of(ids, at, places, prefixes)
            key, first = np.unique(row, return_index=True)
            seen.update(zip(key.tolist(), places[ids[first]].tolist()))
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.int32()), pa.array(list(seen.values()), pa.int32())], ["r", "p"])

    out = np.arange(ROWS) % SIZE
    out[SIZE:] = OTHER
    found = counts.filter("length(word) > 0").mapInArrow(tally, "r int, p int").filter(F.col("r") >= SIZE).groupBy("r").agg(F.min("p").alias("p")).toArrow()
    out[found.column("r").to_numpy()] = found.column("p").to_numpy()
    return out


def next_log_probs(moves: np.ndarray, n_texts: int, deep: np.ndarray = None, fallback: np.ndarray = None) -> np.ndarray:
    """Natural log of the next place after each row, words following each other at random.

    ``moves`` are counts by place; ``deep`` those by all rows, whose beginnings lean on the row
    ``fallback`` of their last subword.
    """
    first, last = moves[END].copy(), moves[:, END].copy()
    first[END], last[END] = 0, 0
    start = (first + 0.1) / (first + 0.1).sum()
    # Where a word ends, the text ends or another word begins.
    ends = n_texts / max(1.0, n_texts + last.sum())
    fresh = (1 - ends) * start
    fresh[END] += ends
    table = moves.copy()
    table[END], table[:, END] = 0, 0
    strength = 1 + (table > 0).sum(1, keepdims=True)
    table += last[:, None] * fresh
    table[END] = 1000 * fresh
    prior = table.sum(0) + 1
    prior /= prior.sum()
    p = ((table + strength * prior) / (table.sum(1, keepdims=True) + strength)).astype(np.float32)
    if deep is None:
        return np.log(p)
    out = np.empty(deep.shape, np.float32)
    out[:SIZE] = np.log(p)
    for s in range(SIZE, len(deep), SIZE):  # a part of the rows at a time
        part = deep[s : s + SIZE].astype(float)
        done = part[:, END].copy()
        part[:, END] = 0
        kinds = 1 + (part > 0).sum(1, keepdims=True) + (done > 0)[:, None]  # a row leans as much as it has varied
        part += done[:, None] * fresh
        out[s : s + SIZE] = np.log((part + kinds * p[fallback[s : s + SIZE]]) / (part.sum(1, keepdims=True) + kinds))
    return out


# The model


class Attention:
    """Parameters and forward pass; ``bias`` are the corpus statistics the head corrects."""

    def __init__(self, bias, seed=1):
        r = np.random.default_rng(seed)
        f = np.float32
        self.emb = (0.1 * r.standard_normal((SIZE + 1, D))).astype(f)
        self.pos = (0.1 * r.standard_normal((2 * BLOCK, D))).astype(f)
        self.q, self.k, self.v = ((r.standard_normal((D, D)) / np.sqrt(D)).astype(f) for _ in range(3))
        self.group, self.member = np.zeros((2 * D, GROUPS), f), np.zeros((GROUPS, 2 * D, GROUPS), f)
        both = bias.reshape(len(bias), GROUPS, GROUPS)
        self.bias_group, self.bias_member = np.empty(both.shape[:2], f), np.empty(both.shape, f)
        for s in range(0, len(both), SIZE):  # a part of the rows at a time
            part = both[s : s + SIZE]
            top = part.max(2, keepdims=True)
            self.bias_group[s : s + SIZE] = top[..., 0] + np.log(np.exp(part - top).sum(2))
            self.bias_member[s : s + SIZE] = part - self.bias_group[s : s + SIZE, :, None]

    NAMES = ("emb", "pos", "q", "k", "v", "group", "member")

    def attend(self, x, prior, keep):
        """States (blocks, 16, 2 D) of blocks ``x`` given the blocks ``prior``; ``keep`` is False where there is none."""
        e, before = self.emb[x], self.emb[prior]
        here = e + self.pos[BLOCK:]
        both = np.concatenate([before + self.pos[:BLOCK], here], 1)
        q, k, v = here @ self.q, both @ self.k, both @ self.v
        s = q @ k.transpose(0, 2, 1) / np.float32(np.sqrt(D))
        mask = np.tril(np.ones((BLOCK, 2 * BLOCK), bool), BLOCK)
        s = np.where(mask & (keep[:, None, None] | (np.arange(2 * BLOCK) >= BLOCK)), np.clip(s, -30, 30), np.float32(-60))
        a = np.exp(s)
        a /= a.sum(2, keepdims=True)
        return (here, both, q, k, v, a), np.concatenate([here, a @ v], 2)

    def log_probs(self, state, now, then):
        """Natural log probability of the places ``then`` after ``now``, from flat states."""
        g = state @ self.group + self.bias_group[now]
        out = np.take_along_axis(g, (then // GROUPS)[:, None], 1)[:, 0] - np.log(np.exp(g).sum(1))
        m = self.bias_member[now, then // GROUPS]
        order = np.argsort((then // GROUPS).astype(np.int16), kind="stable")
        cut = np.searchsorted((then // GROUPS)[order], np.arange(GROUPS + 1))
        for c in range(GROUPS):
            rows = order[cut[c] : cut[c + 1]]
            if len(rows):
                m[rows] += state[rows] @ self.member[c]
        return out + np.take_along_axis(m, (then % GROUPS)[:, None], 1)[:, 0] - np.log(np.exp(m).sum(1))

    def train_step(self, x, prior, keep, then, row=None):
        """Loss and gradients over blocks; ``then`` is PAD where nothing follows, ``row`` the rows of statistics (by default those of ``x``)."""
        (here, both, q, k, v, a), states = self.attend(x, prior, keep)
        at = np.flatnonzero((then != PAD) & (x != PAD))
        at = at[np.argsort((then.ravel()[at] // GROUPS).astype(np.int16), kind="stable")]  # by group
        h, now, t = states.reshape(-1, 2 * D)[at], (x if row is None else row).ravel()[at], then.ravel()[at]
        n, gr, rows = len(t), t // GROUPS, np.arange(len(t))
        cut = np.searchsorted(gr, np.arange(GROUPS + 1))
        g = h @ self.group + self.bias_group[now]
        g = np.exp(g - g.max(1, keepdims=True))
        g /= g.sum(1, keepdims=True)
        m = self.bias_member[now, gr]
        for c in range(GROUPS):
            m[cut[c] : cut[c + 1]] += h[cut[c] : cut[c + 1]] @ self.member[c]
        m = np.exp(m - m.max(1, keepdims=True))
        m /= m.sum(1, keepdims=True)
        loss = -(np.log(g[rows, gr]) + np.log(m[rows, t % GROUPS])).mean()
        g[rows, gr] -= 1
        m[rows, t % GROUPS] -= 1
        g /= n
        m /= n
        grad = {"group": h.T @ g, "member": np.zeros_like(self.member)}
        dh = g @ self.group.T
        for c in range(GROUPS):
            r = slice(cut[c], cut[c + 1])
            grad["member"][c] = h[r].T @ m[r]
            dh[r] += m[r] @ self.member[c].T
        ds = np.zeros_like(states)
        ds.reshape(-1, 2 * D)[at] = dh
        dhere, dctx = ds[..., :D].copy(), ds[..., D:]
        da = dctx @ v.transpose(0, 2, 1)
        dv = a.transpose(0, 2, 1) @ dctx
        dl = a * (da - (da * a).sum(2, keepdims=True)) / np.float32(np.sqrt(D))
        dq, dk = dl @ k, dl.transpose(0, 2, 1) @ q
        over = lambda one, other: one.reshape(-1, D).T @ other.reshape(-1, D)
        grad["q"], grad["k"], grad["v"] = over(here, dq), over(both, dk), over(both, dv)
        dhere += dq @ self.q.T
        dboth = dk @ self.k.T + dv @ self.v.T
        dboth[:, BLOCK:] += dhere
        grad["pos"] = dboth.sum(0)
        dboth[~keep, :BLOCK] = 0
        who = np.concatenate([prior, x], 1).ravel()
        grad["emb"] = np.stack([np.bincount(who, dboth[..., d].ravel(), SIZE + 1) for d in range(D)], 1).astype(np.float32)
        return loss, grad

    def learn(self, parts, visits=102_400, batch=256, rate=0.01, seed=2):
        """Adam over all blocks of ``parts`` (tuples now, prior, keep, then, row); the number of blocks.

        Every block is visited once, in random order inside its part. If there are fewer than
        ``visits`` of them, visits go on at random until that many.
        """
        r = np.random.default_rng(seed)
        state = {n: (np.zeros_like(getattr(self, n)), np.zeros_like(getattr(self, n))) for n in self.NAMES}
        step, total, held = 0, 0, []

        def visit(part, b):
            nonlocal step
            step += 1
            for n, g in self.train_step(*(x[b] for x in part))[1].items():
                mean, square = state[n]
                mean += 0.1 * (g - mean)
                square += 0.01 * (g * g - square)
                p = getattr(self, n)
                p -= (rate / (1 + step / 200) / (1 - 0.9**step) * mean / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)).astype(np.float32)

        for part in parts:
            order = r.permutation(len(part[0]))
            if total < visits:
                held.append(tuple(x[order[: visits - total]] for x in part))
            total += len(order)
            if total >= visits:
                held.clear()
            for s in range(0, len(order), batch):
                visit(part, order[s : s + batch])
        if 0 < total < visits:
            every = tuple(np.concatenate(x) for x in zip(*held))
            for _ in range(-(-(visits - total) // batch)):
                visit(every, r.integers(0, total, min(batch, total)))
        return total

    def weights(self):
        """All trained parameters in one row."""
        return np.concatenate([getattr(self, n).ravel() for n in self.NAMES])

    def set_weights(self, flat):
        for n in self.NAMES:
            p = getattr(self, n)
            p[...] = flat[: p.size].reshape(p.shape)
            flat = flat[p.size :]


def blocks(places, lengths, rows=None):
    """(now, prior, keep, then, text, row) blocks of texts of ``lengths`` places, the end included.

    A text's inputs are the end sign and all its places but the last; its targets are its places.
    """
    n = -(-lengths // BLOCK)
    first = np.cumsum(n) - n
    now = np.full(int(n.sum()) * BLOCK, PAD, np.int16)  # places and rows are below 2^15
    then = np.full(len(now), PAD, np.int16)
    at = spread(lengths, first * BLOCK)
    then[at] = places
    now[first * BLOCK] = END
    begin = np.cumsum(lengths) - lengths
    inner = np.ones(len(places), bool)
    inner[begin + lengths - 1] = False
    now[at[inner] + 1] = places[inner]
    row = now.copy()
    if rows is not None:
        row[at[inner] + 1] = rows[inner]
    now, then = now.reshape(-1, BLOCK), then.reshape(-1, BLOCK)
    keep = np.ones(len(now), bool)
    keep[first] = False
    prior = np.roll(now, 1, axis=0)
    prior[first] = PAD
    return now, prior, keep, then, np.repeat(np.arange(len(lengths)), n), row.reshape(-1, BLOCK)


def text_places(data, off, places, folder, shares, prefixes):
    """(words, places and rows of all subwords with an end after each text, their number per text, log shares within places per text)."""
    w = W.split_words(data, off)
    ids, at = subwords(w.vocab, folder)
    size = np.diff(at)
    length = W.sums(size[w.codes], w.starts) + 1
    every = spread(size[w.codes], at[w.codes])
    out, rows = np.full(int(length.sum()), END), np.full(int(length.sum()), END)
    body = np.ones(len(out), bool)
    body[np.cumsum(length) - 1] = False
    out[body] = places[ids][every]
    rows[body] = rows_of(ids, at, places, prefixes)[every]
    own = np.concatenate([[0.0], np.cumsum(shares[ids], dtype=np.float64)])
    return w, out, rows, length, W.sums((own[at[1:]] - own[at[:-1]])[w.codes], w.starts)


def train_head(model: Attention, docs: DataFrame, n_blocks: int, places, shares, prefixes, visits: int = 102_400, folder: str = FOLDER) -> None:
    """Train the attention head on all rows of ``docs``, in parallel.

    Each task starts from the same parameters and learns from all blocks of its rows; the mean of
    the tasks' parameters, weighted by their blocks, is the head. There are as many tasks as get
    ``visits`` blocks each, so small tables have one.
    """
    sent = docs.sparkSession.sparkContext.broadcast((model, places, shares, prefixes))

    def learn(batches):
        model, places, shares, prefixes = sent.value
        own = Attention.__new__(Attention)
        own.__dict__.update({k: v.copy() if k in Attention.NAMES else v for k, v in model.__dict__.items()})

        def parts():
            for batch in batches:
                for data, off in W.slices(batch.column(0)):
                    _, p, r, length, _ = text_places(data, off, places, folder, shares, prefixes)
                    now, prior, keep, then, _, row = blocks(p, length, r)
                    yield now, prior, keep, then, row

        n = own.learn(parts(), visits)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(own.weights().size + 1), pa.int32()), pa.array(np.append(own.weights().astype(float), 1.0) * n)], ["i", "s"])

    tasks = max(1, n_blocks // visits)
    rows = docs.select("text").filter(F.length("text") > 0).coalesce(tasks)
    found = rows.mapInArrow(learn, "i int, s double").groupBy("i").agg(F.sum("s").alias("s")).toArrow()
    if found.num_rows:
        sums = np.zeros(found.num_rows)
        sums[found.column("i").to_numpy()] = found.column("s").to_numpy()
        model.set_weights((sums[:-1] / sums[-1]).astype(np.float32))


def fit_model(docs: DataFrame, counts: DataFrame, n_texts: int, visits: int = 102_400, folder: str = FOLDER):
    """(model, places, shares, prefixes): statistics from all ``counts``, the attention head from all rows of ``docs``.

    ``shares`` has per subword id the log of its share of its place: 0 but for those in ``OTHER``.
    """
    often = subword_counts(counts, folder)
    places = np.full(len(often), OTHER)
    kept = np.lexsort((np.arange(len(often)), -often))[: SIZE - 2]
    places[kept] = np.arange(2, 2 + len(kept))
    # Subwords never seen share as much as those seen once.
    unseen = max(1, int((often == 1).sum())) / max(1, int((often == 0).sum()))
    rest = np.where(places == OTHER, np.maximum(often, min(0.5, unseen)), 0.0)
    shares = np.where(places == OTHER, np.log(np.where(rest > 0, rest, 1.0) / max(rest.sum(), 1.0)), 0.0).astype(np.float32)
    prefixes = common_prefixes(counts, folder)
    moves, deep = transitions(counts, places, prefixes, folder)
    model = Attention(next_log_probs(moves, n_texts, deep, last_places(counts, places, prefixes, folder)))
    train_head(model, docs, int(often.sum()) // BLOCK, places, shares, prefixes, visits, folder)
    return model, places, shares, prefixes


def frequent_words(counts: DataFrame, most: int = HEAD):
    """(words, counts): the most frequent words of up to ``HEAD_BYTES`` bytes, at most ``most``; all words of a count are in or out."""
    short = counts.filter(F.length("word") <= HEAD_BYTES)
    # One row per number of occurrences.
    sizes = short.groupBy("c").agg(F.count(F.lit(1)).alias("n")).toArrow()
    c, n = sizes.column("c").to_numpy(), sizes.column("n").to_numpy()
    order = np.argsort(-c)
    fits = c[order][np.cumsum(n[order]) <= most]
    if not len(fits):
        return pa.array([], pa.large_binary()), np.zeros(0, np.int64)
    head = short.filter(F.col("c") >= int(fits[-1])).toArrow()
    return head.column("word").cast(pa.large_binary()).combine_chunks(), head.column("c").to_numpy()


def score(docs: DataFrame, divisor: int = 10, folder: str = FOLDER, **fit) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row."""
    held = W.held_out("doc_id", divisor)
    train = docs.filter(~held)
    counts = checkpointed(count_words(train))
    total, distinct, ends = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1)), F.coalesce(F.max(F.when(F.length("word") == 0, F.col("c"))), F.lit(0))).first()
    names, values = frequent_words(counts)
    model, places, shares, prefixes = fit_model(train, counts, ends, folder=folder, **fit)
    sent = docs.sparkSession.sparkContext.broadcast((names, values, model, places, shares, prefixes))

    @F.arrow_udf(returnType="n_tokens long, n_known long, known_sum double, score double, tail array<struct<word: binary, tf: int>>")
    def measure(text: pa.Array) -> pa.Array:
        import pyarrow.compute as pc

        names, values, model, places, shares, prefixes = sent.value
        cols = [[], [], [], [], []]
        for data, off in W.slices(text):
            w, p, r, length, rare = text_places(data, off, places, folder, shares, prefixes)
            found = pc.index_in(w.vocab, value_set=names).to_numpy(zero_copy_only=False)
            missing = np.isnan(found) if found.dtype.kind == "f" else np.zeros(len(found), bool)
            c = np.where(missing, 0, values[np.where(missing, 0, found).astype(np.int64)]) if len(values) else np.zeros(len(found), np.int64)
            known = c[w.codes] > 0
            logs = np.where(c > 0, np.log10(np.maximum(c, 1) + 0.1), 0.0)
            cols[0].append(np.diff(w.starts) + 1)
            cols[1].append(W.sums(known, w.starts) + (1 if ends else 0))
            cols[2].append(W.sums(logs[w.codes], w.starts) + np.log10(ends + 0.1))
            now, prior, keep, then, text_of, row = blocks(p, length, r)
            got = np.zeros(len(length))
            for s in range(0, len(now), BATCH_BLOCKS):
                x, t = now[s : s + BATCH_BLOCKS], then[s : s + BATCH_BLOCKS]
                _, states = model.attend(x, prior[s : s + BATCH_BLOCKS], keep[s : s + BATCH_BLOCKS])
                live = t != PAD
                lp = model.log_probs(states[live], row[s : s + BATCH_BLOCKS][live], t[live])
                got += np.bincount(np.repeat(text_of[s : s + BATCH_BLOCKS], BLOCK)[live.ravel()], lp, minlength=len(length))
            cols[3].append((got + rare) / np.log(10))
            # The other words with their numbers, for the join.
            who = W.owners(w.starts)[~known]
            key, tf = np.unique(who * np.int64(max(1, len(w.vocab))) + w.codes[~known], return_counts=True)
            size = np.bincount(key // max(1, len(w.vocab)), minlength=len(length))
            cols[4].append((size, w.vocab.take(pa.array(key % max(1, len(w.vocab)))).cast(pa.binary()), tf))
        flat = [np.concatenate(x) if x else np.zeros(0) for x in cols[:4]]
        sizes = np.concatenate([[0], *(x[0] for x in cols[4])]).astype(np.int64)
        tail = pa.StructArray.from_arrays([pa.concat_arrays([pa.array([], pa.binary()), *(x[1] for x in cols[4])]), pa.array(np.concatenate([np.zeros(0, int), *(x[2] for x in cols[4])]), pa.int32())], ["word", "tf"])
        tails = pa.ListArray.from_arrays(pa.array(np.cumsum(sizes), pa.int32()), tail)
        return pa.StructArray.from_arrays([pa.array(flat[0], pa.int64()), pa.array(flat[1], pa.int64()), pa.array(flat[2], pa.float64()), pa.array(flat[3], pa.float64()), tails], ["n_tokens", "n_known", "known_sum", "score", "tail"])

    rows = docs.select("doc_id", held.alias("held_out"), measure.asNondeterministic()("text").alias("m")).select("doc_id", "held_out", "m.*")
    # Written once, so that a row's number stays the same whatever is computed again.
    rows = checkpointed(rows.withColumn("row", F.monotonically_increasing_id()))
    tail = rows.select("row", F.explode("tail").alias("t")).select("row", "t.*").join(counts, "word", "left")
    c = F.coalesce("c", F.lit(0))
    rest = tail.groupBy("row").agg(F.sum(F.when(c > 0, F.col("tf")).otherwise(0)).alias("more"), F.sum(F.col("tf") * F.log10(c + 0.1)).alias("rest_sum"))
    out = rows.drop("tail").join(rest, "row", "left")
    norm = float(np.log10(total + 0.1 * (distinct + 1)))
    return out.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("more", F.lit(0))).cast("long").alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
        (F.col("known_sum") + F.coalesce("rest_sum", F.lit(0.0)) - F.col("n_tokens") * F.lit(norm)).alias("base_score"), "score",
    )
