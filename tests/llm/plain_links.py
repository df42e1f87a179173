"""Components by union-find, for comparison."""


def roots(ids, linked):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in linked:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}
