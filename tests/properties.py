"""Checks of the matcher's output by its defining properties, with a plain table-filling LCS.

Nothing is imported from the package, and no walk is replayed: the properties
below have exactly one solution, which the output must be.
"""

from collections import defaultdict


def common(a, b):
    """Longest common subsequence by the textbook table."""
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a)):
        for j in range(len(b)):
            table[i + 1][j + 1] = table[i][j] + 1 if a[i] == b[j] else max(table[i][j + 1], table[i + 1][j])
    return table[len(a)][len(b)]


def score(a, b):
    return 100.0 if not a and not b else 200.0 * common(a, b) / (len(a) + len(b))


def near(a, b, threshold):
    return 200 * common(a, b) >= threshold * (len(a) + len(b))


def check_groups(artists, matches, threshold):
    """``artists``: [(name, plays)]; ``matches``: {name: (canonical, score)} of the grouped names."""
    place, spellings = {}, defaultdict(list)
    for name, plays in artists:
        node = name.lower()
        spellings[node].append(name)
        place[node] = min(place.get(node, (1, "")), (-plays, name))
    nodes = sorted(place, key=place.get)
    beside = {x: {y for y in nodes if x != y and near(x, y, threshold)} for x in nodes}
    grouped = {n.lower() for n in matches}
    teams = defaultdict(set)
    for name, (canonical, _) in matches.items():
        teams[canonical].add(name.lower())
    lead = {}
    for team in teams.values():
        # Teams of different leaders may share a canonical band name; split them by who is beside whom.
        rest = set(team)
        while rest:
            first = min(rest, key=place.get)
            own = {x for x in rest if x == first or x in beside[first]}
            for x in own:
                lead[x] = first
            rest -= own
    leaders = set(lead.values())
    for name in matches:
        assert len([n for n in spellings[name.lower()] if n in matches]) == len(spellings[name.lower()])
    for x in leaders:
        assert not leaders & beside[x], "two leaders are alike"
        assert len(spellings[x]) > 1 or any(lead[y] == x for y in grouped if y != x), "a leader without followers"
    for x in grouped - leaders:
        assert lead[x] == min(leaders & beside[x], key=place.get), "a follower is not with the earliest leader"
    for x in set(nodes) - grouped:
        assert not leaders & beside[x], "an artist beside a leader is left out"
        assert len(spellings[x]) == 1
        free = {y for y in beside[x] if y not in grouped}
        assert not free, "two alike artists are both left out"
    for name, (_, got) in matches.items():
        x = name.lower()
        assert abs(got - (100.0 if x == lead[x] else score(x, lead[x]))) < 1e-9


def check_renames(mapping):
    """Every key leads to a name that no further rename moves elsewhere."""
    for key, name in mapping.items():
        onward = mapping.get(name.lower())
        assert onward is None or onward == name, (key, name, onward)
