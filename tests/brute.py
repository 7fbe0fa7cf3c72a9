"""Plain-Python answers for small inputs."""


def wars(rows, within):
    """Matches from (wiki, title, user, is_bot, byte_delta, type, second, offset) tuples."""
    pages = {}
    for row in sorted(rows, key=lambda r: (r[6], r[7])):
        pages.setdefault(row[:2], []).append(row)
    found = []
    for page, history in pages.items():
        i = 0
        while i + 2 < len(history):
            a, b, c = history[i : i + 3]
            if not a[3] and not b[3] and b[2] != a[2] and c[2] == a[2] and c[6] - a[6] < within:
                found.append((*page, a[2], b[2], a[6], c[6], c[6] - a[6], b[4] + c[4]))
                i += 3
            else:
                i += 1
    return sorted(found)
