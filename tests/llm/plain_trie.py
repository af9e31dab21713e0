"""The conversation trie, node by node in plain Python."""

import hashlib
import zlib
from collections import defaultdict


def plain_trie(rows):
    """``rows`` of (conv_id, turn, role, text) with distinct turns in a conversation."""
    turns = defaultdict(list)
    for conv, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        turns[conv].append((role or "", text or ""))
    whole = {}
    for conv, own in turns.items():
        h = zlib.crc32(str(conv).encode()) % 6
        whole[conv] = tuple(turns.get(conv - conv % 100, [])[:h] + own[h:])
    members = defaultdict(list)
    for conv, seq in whole.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(conv)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    totals = {}
    for node in sorted(members, key=len, reverse=True):
        saved = (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
        leaves = 0 if children[node] else 1
        totals[node] = (leaves + sum(totals[c][0] for c in children[node]), saved + sum(totals[c][1] for c in children[node]))
    return sorted((
        min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(children[node]), *totals[node],
        hashlib.sha256(",".join(map(str, sorted(c for c in convs if len(whole[c]) == len(node)))).encode()).hexdigest(),
    ) for node, convs in members.items())


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
