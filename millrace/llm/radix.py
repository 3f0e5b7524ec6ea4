"""A Patricia trie over byte strings whose terminal nodes own a value."""

from __future__ import annotations

from collections.abc import Callable, Iterator


#: About what a terminal node takes beside its label: node, dictionary, value and hash.
NODE_BYTES = 512


class Node:
    __slots__ = ("label", "children", "value")

    def __init__(self, label: bytes, value=None):
        self.label = label
        self.children: dict[int, Node] = {}
        self.value = value


def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix, by halving: comparisons run over whole slices."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


class RadixTrie:
    """Byte strings in compressed edges; equal strings meet in one terminal node."""

    def __init__(self, merge: Callable):
        self.root = Node(b"")
        self.merge = merge
        self.n_bytes = 0
        self.n_nodes = 0
        self._held: dict[int, tuple[int, int]] = {}  # label bytes and nodes below each edge of the root

    @property
    def size(self) -> int:
        """Bytes that the trie takes; many short strings take mostly nodes."""
        return self.n_bytes + NODE_BYTES * self.n_nodes

    def insert(self, key: bytes, value) -> None:
        node, at, first, added, nodes = self.root, 0, key[0] if key else -1, 0, 0
        while at < len(key):
            child = node.children.get(key[at])
            if child is None:
                node.children[key[at]] = Node(key[at:], value)
                added += len(key) - at
                nodes += 1
                break
            rest = key[at:]
            same = _common(child.label, rest)
            if same < len(child.label):
                # Split the edge where the strings part.
                middle = Node(child.label[:same])
                child.label = child.label[same:]
                middle.children[child.label[0]] = child
                node.children[key[at]] = middle
                child = middle
                nodes += 1
            node, at = child, at + same
        else:
            nodes += node is self.root and node.value is None
            node.value = value if node.value is None else self.merge(node.value, value)
        self.n_bytes += added
        self.n_nodes += nodes
        held = self._held.get(first, (0, 0))
        self._held[first] = held[0] + added, held[1] + nodes

    def _terminals(self, node: Node, prefix: bytes) -> Iterator[tuple[bytes, object]]:
        stack = [(node, prefix)]
        while stack:
            node, prefix = stack.pop()
            key = prefix + node.label
            if node.value is not None:
                yield key, node.value
            stack.extend((child, key) for child in node.children.values())

    def items(self) -> Iterator[tuple[bytes, object]]:
        return self._terminals(self.root, b"")

    def spill(self) -> Iterator[tuple[bytes, object]]:
        """Take out the subtree that holds most bytes and give its terminals.

        A string that comes again later starts a new terminal, so the receiver merges.
        """
        first = max(self._held, key=lambda f: self._held[f][0] + NODE_BYTES * self._held[f][1])
        n_bytes, n_nodes = self._held.pop(first)
        self.n_bytes -= n_bytes
        self.n_nodes -= n_nodes
        child = self.root.children.pop(first, None)
        if child is not None:
            yield from self._terminals(child, b"")
        if first == -1 and self.root.value is not None:
            yield b"", self.root.value
            self.root.value = None
