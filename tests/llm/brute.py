"""Plain Python versions of the operators' results, one loop after the other."""

import hashlib
import re
import zlib
from collections import Counter

import xxhash

SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
BENCH_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def words(text):
    return SPACE_WORD.findall(text or "")


def fingerprint(text):
    w = [x.translate(LOWER) for x in words(text)]
    if not w:
        return 0
    shingles = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def simhash(rows, distance=3):
    """(doc_id, hex, component) of (doc_id, text) rows, by comparing all fingerprints."""
    prints = [(d, fingerprint(t)) for d, t in rows]
    fps = sorted({f for _, f in prints})
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[:i]:
            if bin(a ^ b).count("1") <= distance:
                root[find(a)] = find(b)
    least = {}
    for d, f in prints:
        if d is not None:
            least[find(f)] = min(d, least.get(find(f), d))
    return [(d, f"{f:016x}", least.get(find(f))) for d, f in prints]


def decontaminate(rows, items, size=10):
    def cut(text):
        return BENCH_WORD.findall((text or "").translate(LOWER))

    wins = {}
    for item, text in items:
        w = cut(text)
        n = min(size, len(w))
        for i in range(len(w) - n + 1) if n else ():
            wins.setdefault(tuple(w[i:i + n]), set()).add("" if item is None else str(item))
    sizes = {len(w) for w in wins}
    out = []
    for d, text in rows:
        w = cut(text)
        hit, found = [False] * len(w), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in wins:
                    found |= wins[tuple(w[i:i + n])]
                    hit[i:i + n] = [True] * n
        out.append((d, len(w), sum(hit), len(found), sha(",".join(sorted(found))), any(hit)))
    return out


def substring(rows, size=35):
    docs = [(d, words(t)) for d, t in rows]
    seen = Counter(tuple(w[i:i + size]) for _, w in docs for i in range(len(w) - size + 1))
    out = []
    for d, w in docs:
        gone = [False] * len(w)
        for i in range(len(w) - size + 1):
            if seen[tuple(w[i:i + size])] > 1:
                gone[i:i + size] = [True] * size
        out.append((d, len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g))))
    return out


def suffix(rows, size=100):
    """Rows with one doc_id and one text count as one document."""
    raws = [(d, (t or "").encode()) for d, t in rows]
    docs = sorted(((((1 << 62) + (xxhash.xxh64_intdigest(raw, 42) >> 2)) if d is None else d, raw, d) for d, raw in raws),
                  key=lambda x: x[0])
    first, out = {}, []
    for order, raw, d in docs:
        gone = bytearray(len(raw))
        for i in range(len(raw) - size + 1):
            if first.setdefault(raw[i:i + size], (order, i)) < (order, i):
                gone[i:i + size] = b"\x01" * size
        kept = bytes(x for x, g in zip(raw, gone) if not g)
        out.append((d, len(raw), sum(gone), len(re.findall(b"\x01+", bytes(gone))), sha(kept)))
    return out


def targets(sizes):
    """source -> target, by sharing the excess again until none is above its stop."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, stopped = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[s] for s in stopped)
        share = sum(weight[s] for s in names if s not in stopped)
        new = {s for s in names if s not in stopped and left * weight[s] / share > 3 * sizes[s]}
        if not new:
            return {s: 3.0 * sizes[s] if s in stopped else left * weight[s] / share for s in names}
        stopped |= new


SECRETS = {
    "assign": re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A),
    "access": re.compile("AKIA[A-Z0-9]+"),
    "hex": re.compile("[0-9a-f]+"),
}


def mixed(rows, seed=17):
    """(doc_id, source, size, copies) of (doc_id, text, source) rows: one walk over each source's draws."""
    sizes, draws = Counter(), {}
    for d, t, source in rows:
        size = len(words(t))
        sizes[source] += size
        key = hashlib.md5("|".join(str(x) for x in (seed, d, t) if x is not None).encode()).hexdigest()
        draws.setdefault(source, []).append((int(key[:13], 16) / 2 ** 52, int(key[13:26], 16) / 2 ** 52, size, d))
    out, want = [], targets(sizes)
    for source, drawn in draws.items():
        whole = int(want[source] / sizes[source]) if sizes[source] else 0
        left, at, last = want[source] - whole * sizes[source], 0, -1
        for u in sorted({x[0] for x in drawn if x[2]}):
            same = [x for x in drawn if x[0] == u]
            if at + same[0][1] * sum(x[2] for x in same) < left:
                last = u
            at += sum(x[2] for x in same)
        out += [(d, source, size, whole + (u <= last)) for u, _, size, d in drawn]
    return out


def base_spans(text):
    found = []
    for i, (kind, regex) in enumerate(SECRETS.items()):
        for m in regex.finditer(text or ""):
            if (len(m[2]) >= 6 if kind == "assign" else len(m[0]) >= (20 if kind == "access" else 24)):
                found.append((m.start(), i, m.end(), kind))
    return [(s, e, k) for s, _, e, k in sorted(found)]


def warc(rows):
    first = {}
    for p, html in rows:
        if p is not None:
            first[sha(html or "")] = min(p, first.get(sha(html or ""), p))
    out = []
    for p, html in rows:
        raw = (html or "").encode()
        f = first.get(sha(raw))
        again = len(raw) >= 100 and f is not None and p != f
        out.append((p, len(raw), sha(raw), "revisit" if again else "response", f if again else None))
    return out


def quality(text):
    w = words(text)
    wins = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    hit = [False] * len(w)
    for i in range(len(w) - 4):
        if wins[tuple(w[i:i + 5])] > 1:
            hit[i:i + 5] = [True] * 5
    lines = [x for x in (text or "").split("\n") if words(x)]
    base = len(w) < 10 or 100 * sum(hit) > 20 * len(w)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), sum(hit), base)


def chat(rows, part=1_000_000):
    """(conv_id, part, speaker, n_turns, n_own, rendered, masks)."""
    convs = {}
    for c, turn, role, text in rows:
        convs.setdefault(c, []).append((turn is None, turn or 0, role or "unknown", text or ""))
    out = []
    for c, turns in convs.items():
        turns.sort()
        parts, size, opening, open_ = {}, 0, [], True
        for t in turns:
            open_ = open_ and t[2] == "system"
            if open_ and size // part == 0:
                opening.append(t)
            parts.setdefault(size // part, []).append(t)
            size += len(t[2]) + len(t[3]) + 16
        if all(t[2] == "system" for t in turns):
            continue
        for speaker in {t[2] for t in turns} - {"system"}:
            for p, own in parts.items():
                text, masks, said = "", [], (opening if p else []) + own
                for _, _, role, body in said:
                    name = "assistant" if role == speaker else "system" if role == "system" else f"user name={role}"
                    text += f"<|{name}|>\n"
                    if role == speaker:
                        masks.append(f"{len(text)}:{len(text) + len(body)}")
                    text += body + "<|end|>\n"
                out.append((c, p, speaker, len(said), len(masks), text, ",".join(masks)))
    return out


def crc_held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0


def trie(rows):
    """(conv_id, depth, parent, n_convs, n_children, n_leaves, saved_tokens, ends_sha256); ties follow the hash the operator names."""
    def order(r):
        return (r[1] is not None, r[1] or 0, *tie_hash(r[2] or "", r[3] or ""))

    convs = {}
    for r in rows:
        if r[0] is not None:
            convs.setdefault(r[0], []).append(r)
    turns = {c: [(r[2] or "", r[3] or "") for r in sorted(rs, key=order)] for c, rs in convs.items()}
    paths = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        paths[c] = tuple(turns.get(c - (abs(c) % 20 if c >= 0 else -(abs(c) % 20)), [])[:h] + own[h:])
    nodes = {}
    for c in sorted(paths):
        for d in range(len(paths[c]) + 1):
            nodes.setdefault(paths[c][:d], []).append(c)
    kids, leaves, saved = Counter(), Counter(), Counter()
    for p in nodes:
        if p:
            kids[p[:-1]] += 1
    for p, cs in nodes.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += (len(cs) - 1) * len(words(p[-1][1])) if p else 0
    return [(cs[0], len(p), nodes[p[:-1]][0] if p else None, len(cs), kids[p], leaves[p], saved[p],
             sha(",".join(str(c) for c in cs if paths[c] == p))) for p, cs in nodes.items()]


def tie_hash(role, text):
    """Spark's xxhash64 of two strings, seed 42, and of 7 and both, as signed numbers."""
    def signed(x):
        return x - (1 << 64) if x >> 63 else x

    def chain(seed):
        return signed(xxhash.xxh64_intdigest(text.encode(), xxhash.xxh64_intdigest(role.encode(), seed)))

    return chain(42), chain(xxhash.xxh64_intdigest((7).to_bytes(4, "little"), 42))


def spot_words(text):
    return BENCH_WORD.findall((text or "").translate(LOWER))


def spot_set(w, anchors):
    found, after = set(), []
    for x in reversed(w):
        if x not in anchors:
            after = [x, *after[:1]]
        elif len(after) == 2:
            found.add((x, *after))
    if not found and w:
        found = {tuple(w[i:i + 2]) for i in range(max(1, len(w) - 1))}
    return found


def spotsigs(rows, anchors=256):
    """(doc_id, n_chars, edited_sha256, near_edited, near_next); doc_ids differ. Ties among the common words follow their hash."""
    import numpy as np

    from marketsignals.llm.textkit import ALNUM, word_hashes

    def word_hash(x):
        raw = np.frombuffer(x.encode(), np.uint8)
        return int(word_hashes(raw, np.array([0]), ALNUM).view(np.int64)[0])

    df = Counter(x for _, t in rows for x in set(spot_words(t)))
    edge = sorted(df.values(), reverse=True)[min(anchors, len(df)) - 1] if df else 0
    rank = sorted((-n, word_hash(x), x) for x, n in df.items() if n >= edge)
    common = {x for _, _, x in rank[:anchors]}
    docs = sorted(rows, key=lambda r: -r[0])
    out = []
    for i, (d, t) in enumerate(docs):
        t, nxt = t or "", docs[(i + 1) % len(docs)][1] or ""
        k = len(t) // 3
        edited = t[:len(t) - k] + nxt[:k]
        a, b, c = (spot_set(spot_words(x), common) for x in (t, edited, nxt))
        near = [len(a & x) / len(a | x) if a | x else 1.0 for x in (b, c)]
        out.append((d, len(t), sha(edited), *near))
    return out


_CODEC = []


def token_groups(text):
    """Token ids and byte ends by A and B; empty where the bytes do not come back."""
    from marketsignals.llm.pair_bitmaps import A_FILE, B_FILE, VOCAB_DIR, Codec

    if not _CODEC:
        _CODEC.append(Codec(VOCAB_DIR, A_FILE, B_FILE))
    codec = _CODEC[0]
    a = codec.a.encode(" " + (text or ""), add_special_tokens=False).ids
    b = codec.b.encode(text or "")
    raw = (" " + (text or "")).encode()
    if not text or b"".join(codec.a_bytes[i] for i in a) != raw or b"".join(codec.b_bytes[i] for i in b) != raw:
        return [], []
    out = []
    for ids, table in ((a, codec.a_bytes), (b, codec.b_bytes)):
        at, spans = 0, []
        for i in ids:
            spans.append((i, at, at + len(table[i])))
            at += len(table[i])
        out.append(spans)
    return out


def groups_of(text):
    sides = token_groups(text)
    cuts = {e for _, _, e in sides[0]} & {e for _, _, e in sides[1]}
    groups = []
    for side in sides:
        got, now = [], []
        for i, _, e in side:
            now.append(str(i))
            if e in cuts:
                got.append(",".join(now))
                now = []
        groups.append(got)
    return ";".join(f"{x}|{y}" for x, y in zip(*groups))


def links_of(text):
    a, b = token_groups(text)
    out, j = [], 0
    for i, s, e in a:
        while j and b[j - 1][2] > s:
            j -= 1
        while j < len(b) and b[j][1] < e:
            if b[j][2] > s:
                out.append((i, b[j][0]))
            j += 1
    return out


def pair_counts(rows):
    docs, links = Counter(), Counter()
    for _, t in rows:
        found = links_of(t)
        links.update(found)
        docs.update(set(found))
    return {p: (docs[p], links[p]) for p in docs}


def alignment(rows):
    each = {t: links_of(t) for _, t in rows}
    count = Counter(p for _, t in rows for p in set(each[t]))
    top = {}
    for (a, _), n in count.items():
        top[a] = max(n, top.get(a, 0))
    out = []
    for d, t in rows:
        a, b = token_groups(t)
        text = groups_of(t) if a else ""
        out.append((d, len(a), len(b), text.count(";") + 1 if text else 0, len(each[t]), sum(count[p] == top[p[0]] for p in each[t]),
                    sum(count[p] for p in each[t]), sha(text) if text else ""))
    return out
