"""A z-fast trie over sequences that are known by the hashes of their prefixes.

A compacted trie node has an edge that covers the depths ``lo + 1 .. hi`` (``hi`` is its extent's length, ``lo`` its
parent's).  It is filed in a hash table under its *handle*: the prefix of its extent whose depth is the
two-fattest number of ``(lo, hi]``, the one divisible by the highest power of two.  The *exit node* of a
sequence, the node on whose edge the sequence leaves the trie, is found by fat binary search: probe the
two-fattest depth of the interval that is left, go below the node found, or above the depth not found.  That
takes a number of probes logarithmic in the depth, not one per element.

Prefixes are compared by hashes: two sequences agree down to depth ``d`` if the hashes of their first ``d``
elements do (128 bits, which hold position and content of every element).
"""

from __future__ import annotations


def two_fattest(a: int, b: int) -> int:
    """The number of ``a < x <= b`` that is divisible by the highest power of two."""
    return b & -1 << ((a ^ b).bit_length() - 1)


class Node:
    """Edge ``(lo, hi]`` above a node.  ``keys[d - base]`` is the hash of the first ``d`` elements of the sequence that made it,
    ``words[d - base - 1]`` a number of its ``d``-th element.  ``weights`` are sums over the sequences that end at the node,
    ``least`` the smallest identifier among those."""

    __slots__ = ("lo", "hi", "base", "keys", "words", "up", "least", "weights")

    def __init__(self, lo, hi, base, keys, words, up):
        self.lo, self.hi, self.base, self.keys, self.words, self.up = lo, hi, base, keys, words, up
        self.least, self.weights = None, [0, 0, 0]

    def key(self, depth: int) -> bytes:
        return self.keys[depth - self.base]


class ZFastTrie:
    """Sequences below one or more roots; a root is the hash of what came before it."""

    def __init__(self):
        self.roots: dict[bytes, Node] = {}
        self.handles: dict[bytes, Node] = {}    # hash of the handle -> node
        self.first: dict[bytes, Node] = {}      # hash of the extent's first lo + 1 elements -> node
        self.size = 0                           # elements on all edges

    def _file(self, n: Node) -> None:
        self.handles[n.key(two_fattest(n.lo, n.hi))] = n
        self.first[n.key(n.lo + 1)] = n

    def exit_node(self, root: Node, keys: list[bytes]) -> Node:
        """The deepest node that shares an element of its edge with the sequence, or ``root``."""
        node, base, a, b = root, root.hi, root.hi, root.hi + len(keys) - 1
        while a < b:
            f = two_fattest(a, b)
            found = self.handles.get(keys[f - base])
            if found is None:
                b = f - 1
            elif found.hi - base < len(keys) and keys[found.hi - base] == found.key(found.hi):
                node, a = found, found.hi       # its whole extent is a prefix
                b = max(a, b)
            else:
                return found                    # the sequence ends or turns off below the handle, on this edge
        end = root.hi + len(keys) - 1
        return self.first.get(keys[node.hi - base + 1], node) if node.hi < end else node

    def insert_batch(self, batch: list[tuple]) -> None:
        """Sequences ``(start, keys, words, least, weights)``: depth of the root, hashes of the prefixes from the root's on, a
        number per element, smallest identifier, sums to add at the end.  Equal sequences of a batch come as one."""
        for item in batch:
            self.insert(*item)

    def insert(self, start, keys, words, least, weights) -> None:
        root = self.roots.get(keys[0])
        if root is None:
            root = self.roots[keys[0]] = Node(start, start, start, keys[:1], [], None)
        end = start + len(keys) - 1
        node = self.exit_node(root, keys)
        lo, hi = node.lo, min(node.hi, end)
        while lo < hi:                          # longest common prefix, by binary search on the edge
            mid = (lo + hi + 1) // 2
            if keys[mid - start] == node.key(mid):
                lo = mid
            else:
                hi = mid - 1
        if lo < node.hi:                        # turns off or ends inside the edge: split it there
            top = Node(node.lo, lo, node.base, node.keys, node.words, node.up)
            node.lo, node.up = lo, top
            self._file(top)
            self._file(node)
            node = top
        if node.hi < end:
            below = Node(node.hi, end, start, keys, words, node)
            self._file(below)
            self.size += end - node.hi
            node = below
        if node.least is None or least < node.least:
            node.least = least
        for i, w in enumerate(weights):
            node.weights[i] += w

    def nodes(self) -> list[Node]:
        """Every node, parents before children; roots first."""
        return [*sorted(self.roots.values(), key=lambda n: n.hi), *sorted(self.first.values(), key=lambda n: n.lo)]

    def gather(self) -> list[Node]:
        """Adds what ended below to every node above; returns ``nodes()``."""
        every = self.nodes()
        for n in reversed(every):
            if n.up is not None:
                if n.up.least is None or n.least < n.up.least:
                    n.up.least = n.least
                for i, w in enumerate(n.weights):
                    n.up.weights[i] += w
        return every
