"""Plain-Python results of the training-data queries, straight from their definitions."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import xxhash
from tokenizers import Tokenizer

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def statistics(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed"""
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    times = Counter(zip(words, words[1:], words[2:]))
    repeated = {j for i in range(len(words) - 2) if times[tuple(words[i:i + 3])] > 1 for j in range(i, i + 3)}
    n, r = len(words), len(repeated)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), r,
            n < 50 or 100 * r > 50 * n)


def luhn(digits):
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def base_spans(text):
    out = []
    for rank, (kind, pattern) in enumerate(PII.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                    "card": 14 <= len(digits) <= 19 and luhn(digits), "phone": 10 <= len(digits) <= 15}[kind]:
                out.append((m.start(), rank, m.end(), kind))
    return sorted(out)


def without_repeats(docs):
    """(doc_id, n_words, n_removed, sha) of [(doc_id, text)], in the order given."""
    seen, out = set(), []
    for doc, text in docs:
        words = WORD.findall(text or "")
        gone = [False] * len(words)
        for i in range(len(words) - 19):
            window = tuple(words[i:i + 20])
            if window in seen:
                gone[i:i + 20] = [True] * 20
            seen.add(window)
        out.append((doc, len(words), sum(gone), sha(" ".join(w for w, g in zip(words, gone) if not g))))
    return out


def fingerprint(text):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return 0
    runs = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(runs))


def near_groups(fps):
    """Index of the group of each fingerprint, linked at three bits or fewer."""
    group, fps = list(range(len(fps))), np.array(fps, dtype=np.uint64)

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(fps[:i] ^ fps[i]) <= 3):
            group[root(i)] = root(int(j))
    return [root(i) for i in range(len(fps))]


def bench_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def contamination(docs, items):
    """(doc_id, n_words, n_hit, n_items, sha of items, contaminated)"""
    windows = {}
    for item, text in items:
        words = bench_words(text)
        for i in range(max(1, len(words) - 12)) if words else []:
            windows.setdefault(tuple(words[i:i + 13]), set()).add(str(item))
    sizes, out = {len(w) for w in windows}, []
    for doc, text in docs:
        words, hit, found = bench_words(text), set(), set()
        for size in sizes:
            for i in range(len(words) - size + 1):
                items_here = windows.get(tuple(words[i:i + size]))
                if items_here:
                    hit |= set(range(i, i + size))
                    found |= items_here
        out.append((doc, len(words), len(hit), len(found), sha(",".join(sorted(found))), bool(hit) and 20 * len(hit) >= len(words)))
    return out


def chats(rows):
    """conv_id -> (n_turns, turns sha, loss chars, loss sha)"""
    by = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1], r[2] or "", r[3] or "")):
        by.setdefault(conv, []).append((role or "", text or ""))
    out = {}
    for conv, turns in by.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        out[conv] = (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss))
    return out


def token_ids(name, texts, end):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    tokenizer.encode_special_tokens = True
    done = tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)
    return [np.array([*e.ids, end], dtype="<u4") for e in done]


def crc(ids):
    return zlib.crc32(ids.tobytes())
