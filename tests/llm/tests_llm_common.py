SF = "/root/testdata/sf0.001"


def groups(ids, links):
    """Smallest reachable id of every id, by union-find."""
    up = {i: i for i in ids}

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {i: find(i) for i in up}
