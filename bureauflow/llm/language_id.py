"""Language identification by a bidirectional gated recurrent network over bytes (operator 8).

The network reads whole texts byte by byte in both directions, blanks included, and labels every byte position with language probabilities;
a document's probabilities are their mean over all its positions. Texts over WINDOW bytes are labelled in even windows: in each direction the
state begins CONTEXT bytes outside the window (or at the text's end), so every position is labelled after all that stands before it in its
window and CONTEXT bytes more. Windows of all texts are lanes of one array, so a very long text is many lanes and not many steps. Training is
backpropagation through time in numpy on passages of a bounded sample of labelled rows (TRAIN_ROWS by hash order, of each TRAIN_CHARS
characters in a row at most, from a place given by a hash).

Defined results: null text and text without a letter are `und` with score 0; equal probabilities go to the language that sorts first;
without any labelled row everything is `und`; repeated rows are labelled each; an empty table gives an empty result; a text's answer does
not depend on the rows beside it but for rounding.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bureauflow.llm import ragged

TRAIN_ROWS = 2_000
TRAIN_CHARS = 1_000
HIDDEN = 8
STEPS = 400
BATCH = 192
#: Bytes of a passage that the network learns from.
PASSAGE = 64
RATE = 0.02
#: Bytes of a text that a lane labels at most, and bytes that it reads before them in either direction.
WINDOW = 1024
CONTEXT = 48
#: Lanes read side by side. Results don't depend on it.
LANES = 1024


@dataclass
class Model:
    langs: list[str]
    weights: dict[str, np.ndarray]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def run(w: dict[str, np.ndarray], side: str, x: np.ndarray, mask: np.ndarray, kept: list | None = None) -> np.ndarray:
    """States after each byte, (time, passage, hidden), as training needs them."""
    table, u, v = w[f"W{side}"], w[f"U{side}"], w[f"C{side}"]
    size = v.shape[0]
    h = np.zeros((x.shape[1], size), table.dtype)
    out = np.empty((*x.shape, size), table.dtype)
    for t in range(len(x)):
        given = table[x[t]]
        gate = sigmoid(given[:, : 2 * size] + h @ u)
        r, z = gate[:, :size], gate[:, size:]
        n = np.tanh(given[:, 2 * size :] + (r * h) @ v)
        new = np.where(mask[t][:, None], z * h + (1 - z) * n, h)
        if kept is not None:
            kept.append((h, r, z, n))
        h = out[t] = new
    return out


def back(w: dict[str, np.ndarray], side: str, x: np.ndarray, mask: np.ndarray, kept: list, above: np.ndarray, grad: dict[str, np.ndarray]) -> None:
    """Adds the gradients of one direction; above: those of the states."""
    u, v = w[f"U{side}"], w[f"C{side}"]
    size = v.shape[0]
    dh = np.zeros_like(above[0])
    dg = np.empty((*x.shape, 3 * size), u.dtype)
    for t in range(len(x) - 1, -1, -1):
        h, r, z, n = kept[t]
        dh = dh + above[t]
        live = mask[t][:, None]
        d = np.where(live, dh, 0)
        dn = d * (1 - z) * (1 - n * n)
        drh = dn @ v.T
        gate = np.concatenate([drh * h * r * (1 - r), d * (h - n) * z * (1 - z)], 1)
        grad[f"C{side}"] += (r * h).T @ dn
        grad[f"U{side}"] += h.T @ gate
        dg[t] = np.concatenate([gate, dn], 1)
        dh = np.where(live, d * z + drh * r + gate @ u.T, dh)
    np.add.at(grad[f"W{side}"], x.ravel(), dg.reshape(-1, 3 * size))


def turned(x: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Each passage's bytes from the last to the first; (time, passage)."""
    t = np.arange(len(x))[:, None]
    return np.take_along_axis(x, np.where(t < size, size - 1 - t, t), 0)


def positions(w: dict[str, np.ndarray], x: np.ndarray, size: np.ndarray, kept: tuple[list, list] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Label probabilities of every position, the states behind them, and the mask."""
    t = np.arange(len(x))[:, None]
    mask = t < size
    ahead = run(w, "f", x, mask, kept and kept[0])
    behind = run(w, "b", turned(x, size), mask, kept and kept[1])
    behind = np.take_along_axis(behind, np.where(mask, size - 1 - t, t)[:, :, None], 0)
    both = np.concatenate([ahead, behind], 2)
    logit = both @ w["V"] + w["c"]
    p = np.exp(logit - logit.max(2, keepdims=True))
    return p / p.sum(2, keepdims=True), both, mask


def padded(buf: np.ndarray, starts: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Bytes of passages, (time, passage), zero after their ends."""
    t = np.arange(max(1, int(size.max(initial=1))))[:, None]
    return np.where(t < size, buf[np.minimum(starts + t, max(0, len(buf) - 1))], 0)


def fit(rows: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", seed: int = 5) -> Model:
    """Learns from TRAIN_ROWS rows that have text and language, by order of a hash of the key."""
    known = rows.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(key, text, lang)
    order = F.xxhash64(F.col(key).cast("string"))
    cut = known.select(order.alias("h")).orderBy("h").limit(TRAIN_ROWS).agg(F.max("h")).first()[0]
    place = F.pmod(order, F.greatest(F.char_length(text) - TRAIN_CHARS + 1, F.lit(1))).cast("int") + 1
    part = F.substring(F.col(text), place, F.lit(TRAIN_CHARS)).alias(text)
    # TRAIN_ROWS rows of TRAIN_CHARS characters at most
    sample = sorted((r[1], r[0]) for r in known.where(order <= F.lit(cut)).orderBy(order).limit(TRAIN_ROWS).select(part, lang).collect() if r[0]) if cut is not None else []
    langs = sorted({a for a, _ in sample})
    if not langs:
        return Model([], {})
    rng = np.random.default_rng(seed)
    buf, bounds = ragged.text_bytes(pa.array([t for _, t in sample], pa.string()))
    label = np.searchsorted(langs, [a for a, _ in sample])
    # languages weigh the same, and of one language every byte does
    length = np.diff(bounds)
    weight = length / np.bincount(label, length, len(langs))[label]
    weight /= weight.sum()
    init = lambda *shape: rng.normal(0, 0.3, shape).astype(np.float32)
    w = {"V": init(2 * HIDDEN, len(langs)), "c": np.zeros(len(langs), np.float32)}
    for side in "fb":
        w |= {f"W{side}": init(256, 3 * HIDDEN), f"U{side}": init(HIDDEN, 2 * HIDDEN), f"C{side}": init(HIDDEN, HIDDEN)}
    slow, fast = {k: np.zeros_like(a) for k, a in w.items()}, {k: np.zeros_like(a) for k, a in w.items()}
    picks, places = rng.choice(len(label), (STEPS, BATCH), p=weight), rng.random((STEPS, BATCH))
    for step in range(STEPS):
        some = picks[step]
        size = np.minimum(length[some], PASSAGE)
        x = padded(buf, bounds[some] + (places[step] * (length[some] - size + 1)).astype(np.int64), size)
        kept: tuple[list, list] = ([], [])
        p, both, mask = positions(w, x, size, kept)
        # cross entropy of every position
        d = p
        d[:, np.arange(BATCH), label[some]] -= 1
        d *= (mask / mask.sum())[:, :, None]
        grad = {k: np.zeros_like(a) for k, a in w.items()}
        flat = d.reshape(-1, len(langs))
        grad["V"], grad["c"] = both.reshape(len(flat), -1).T @ flat, flat.sum(0)
        up = d @ w["V"].T
        t = np.arange(len(x))[:, None]
        back(w, "f", x, mask, kept[0], up[:, :, :HIDDEN], grad)
        back(w, "b", turned(x, size), mask, kept[1], np.take_along_axis(up[:, :, HIDDEN:], np.where(mask, size - 1 - t, t)[:, :, None], 0), grad)
        rate = RATE * (1 - step / STEPS) + 1e-4
        for k in w:
            slow[k] += 0.1 * (grad[k] - slow[k])
            fast[k] += 0.01 * (grad[k] ** 2 - fast[k])
            w[k] -= (rate * slow[k] / (1 - 0.9 ** (step + 1)) / (np.sqrt(fast[k] / (1 - 0.99 ** (step + 1))) + 1e-8)).astype(np.float32)
    return Model(langs, w)


def states(w: dict[str, np.ndarray], side: str, x: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """States after each byte, (time, hidden, lane); those of `run`, but zero outside."""
    size = w[f"C{side}"].shape[0]
    # half the gates' input, as their sigmoid is a tanh of half of it
    scale = np.repeat(np.array([0.5, 1.0], np.float32), [2 * size, size])
    table, u, v = np.ascontiguousarray((w[f"W{side}"] * scale).T), np.ascontiguousarray(w[f"U{side}"].T * np.float32(0.5)), np.ascontiguousarray(w[f"C{side}"].T)
    lanes = x.shape[1]
    h = np.zeros((size, lanes), np.float32)
    out = np.empty((len(x), size, lanes), np.float32)
    gate, n, given = np.empty((2 * size, lanes), np.float32), np.empty((size, lanes), np.float32), np.empty((3 * size, lanes), np.float32)
    live = inside.astype(np.float32)
    for t in range(len(x)):
        np.take(table, x[t], axis=1, out=given, mode="clip")
        np.matmul(u, h, out=gate)
        gate += given[: 2 * size]
        np.tanh(gate, out=gate)
        gate *= 0.5
        gate += 0.5
        r, z = gate[:size], gate[size:]
        r *= h
        np.matmul(v, r, out=n)
        n += given[2 * size :]
        np.tanh(n, out=n)
        new = out[t]
        np.subtract(h, n, out=new)
        new *= z
        new += n
        new *= live[t]
        h = new
    return out


def windows(bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and documents of the windows: each text's bytes, cut evenly into as few as WINDOW allows."""
    length = np.diff(bounds)
    number = -(-length // WINDOW)
    doc = np.repeat(np.arange(len(length)), number)
    k = np.arange(len(doc)) - np.repeat(np.cumsum(number) - number, number)
    cut = lambda k: bounds[doc] + k * length[doc] // number[doc]
    return cut(k), cut(k + 1), doc


def label_sums(model: Model, buf: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of the positions' probabilities of each document, (document, language)."""
    starts, ends, doc = windows(bounds)
    w, each = model.weights, np.zeros((len(starts), len(model.langs)))
    order = np.argsort(ends - starts, kind="stable")
    for some in np.array_split(order, -(-len(order) // LANES)) if len(order) else ():
        size = ends[some] - starts[some]
        place = starts[some] + np.arange(-CONTEXT, int(size.max()) + CONTEXT)[:, None]
        inside = (place >= bounds[doc[some]]) & (place < np.minimum(bounds[doc[some] + 1], ends[some] + CONTEXT))
        x = buf[np.clip(place, 0, len(buf) - 1)]
        ahead = states(w, "f", x[:-CONTEXT], inside[:-CONTEXT])[CONTEXT:]
        behind = states(w, "b", x[: CONTEXT - 1 : -1], inside[: CONTEXT - 1 : -1])[: CONTEXT - 1 : -1]
        for t in range(0, len(ahead), 64):
            mask = (np.arange(t, min(t + 64, len(ahead)))[:, None] < size)[:, None, :]
            logit = np.matmul(w["V"][:HIDDEN].T, ahead[t : t + 64]) + np.matmul(w["V"][HIDDEN:].T, behind[t : t + 64]) + w["c"][:, None]
            p = np.exp(logit - logit.max(1, keepdims=True))
            p *= mask / p.sum(1, keepdims=True)
            each[some] += p.sum(0, dtype=np.float64).T
    out = np.zeros((len(bounds) - 1, len(model.langs)))
    np.add.at(out, doc, each)
    return out


def predict(docs: DataFrame, model: Model, kept: list[str] | None = None, text: str = "text") -> DataFrame:
    """Columns kept (all, if None), lang_pred, score. Clashing columns of docs give way to the new ones."""
    kept = [c for c in (docs.columns if kept is None else kept) if c not in ("lang_pred", "score")]
    inner = docs.select(*kept, F.col(text).alias("__text")).schema

    def labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, bounds = ragged.text_bytes(batch.column(len(kept)))
            langs, scores = [], []
            for _, _, part, offs in ragged.slices(buf, bounds):
                letters = np.concatenate([[0], np.cumsum(ragged.byte_classes(part)[0] == ragged.LETTER)]) if len(part) else np.zeros(1, np.int64)
                has = letters[offs[1:]] > letters[offs[:-1]]
                if model.langs:
                    sums = label_sums(model, part, offs)
                    best = sums.argmax(1)
                    score = np.where(has, sums.max(1) / np.maximum(sums.sum(1), 1e-9), 0.0)
                else:
                    has, best, score = has & False, np.zeros(len(has), int), np.zeros(len(has))
                langs += [model.langs[b] if ok else "und" for b, ok in zip(best.tolist(), has.tolist(), strict=True)]
                scores.append(np.clip(score, 0, 1))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(kept)], pa.array(langs, pa.string()), pa.array(np.concatenate(scores) if scores else np.empty(0))], [*kept, "lang_pred", "score"]
            )

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in inner.fields[:-1])
    return docs.select(*kept, F.col(text).alias("__text")).mapInArrow(labelled, f"{kinds}, lang_pred string, score double")


def held_out(key: str = "doc_id"):
    """Rows that are kept from all learning."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 3 == 1, F.lit(False))
