"""Small inputs and brute-force versions that several tests share."""

import re

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, n_words int, size string, "
          "shard int, fp string, rest string, kept string, ids string, copies int, guest string, host string, "
          "fail_bits string, component_id string, bucket string, found string, __words int, __id string, __source int, "
          "__size string, __copies string, __place int, __copy int, __hash string, __own_hash int, __n int, __key string, "
          "__range string, __cell string, component int, cell string, block string, text_hash string, vslot string")
EXTRA = (7, "x", 3, "a", "r", "k", "i", 2, "g", "h", "b", "c", "u", "f", 99, "I", 5, "S", "C", 6, 8, "H", 9, 10, "K", "R", "L",
         11, "l", "B", "T", "V")

LONG = " ".join(f"word{i % 5003} énd{i % 977}." for i in range(20_000))
PASSAGE = " ".join(f"passage{i}" for i in range(60))

TEXTS = [
    (0, "The quick brown fox jumps over the lazy dog. " * 4 + PASSAGE, "s1"),
    (1, None, "s1"),
    (2, "", None),
    (3, " \t\n ", "s2"),
    (4, "one", "s2"),
    (5, "The quick brown fox jumps over the lazy dog. " * 4 + PASSAGE, "s1"),
    (6, LONG, "s3"),
    (7, "ünïcödé 日本語 😀 " * 30 + PASSAGE + " tail", "s3"),
    (8, "a" * 1500, "s2"),
    (9, "line of words here\n" * 30, None),
    (11, LONG[:4000] + " other end", "s1"),
    (11, LONG[:4000] + " other end", "s1"),
    (12, "### $$$ %%% &&& " * 40, "s2"),
    (None, "a document without an id " + PASSAGE, "s1"),
    (None, None, None),
]


def edge_docs(spark, rows=TEXTS):
    """Nulls, empty, blank, long and repeated texts, repeated and missing
    ids, and extra columns whose names operators use themselves."""
    return spark.createDataFrame(
        [(i, t, None if k % 3 else "en", s, None if t is None else len(t), *EXTRA) for k, (i, t, s) in enumerate(rows)], SCHEMA)


def ordered(rows):
    """Rows (id, text, ...) by id, then text; missing ids last."""
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))


def simhash(text):
    words = WORD.findall((text or "").translate({i: i + 32 for i in range(65, 91)}))
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def components(prints, radius=3):
    """Root index of each fingerprint under links of ``radius`` bits."""
    values = np.array(prints, np.uint64)
    parent = list(range(len(prints)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(values[i] ^ values[i + 1:]) <= radius):
            a, b = root(i), root(i + 1 + int(j))
            parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(prints))]


def cut_bytes(texts, length=100):
    """Removal masks of ordered texts: bytes in windows that start earlier."""
    seen, masks = set(), []
    for text in texts:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            window = data[i:i + length]
            if window in seen:
                gone[i:i + length] = b"\1" * length
            seen.add(window)
        masks.append(gone)
    return masks


def spans(mask):
    return sum(1 for i, x in enumerate(mask) if x and (i == 0 or not mask[i - 1]))


def cut_words(texts, window=20):
    """(words, removed mask) of ordered texts."""
    seen, out = set(), []
    for text in texts:
        words = WORD.findall(text or "")
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            key = tuple(words[i:i + window])
            if key in seen:
                gone[i:i + window] = [True] * window
            seen.add(key)
        out.append((words, gone))
    return out


def text_after(data, mask):
    """The text without characters all of whose bytes are removed."""
    out, at = [], 0
    for char in data:
        n = len(char.encode())
        if not all(mask[at:at + n]):
            out.append(char)
        at += n
    return "".join(out)
