"""Brute-force statement of the seven reports in plain Python loops (test oracle only).

Written from the report semantics (DISTINCT-then-COUNT, own-post rule, follow attribution, ...)
without any of the library's code, for differential tests on small random tables.
"""

import calendar
from collections import Counter, defaultdict

from test_properties import py_text_strip, py_tokens

SERVICE = {"facebook": "FB", "facebookpages": "FB", "instagram": "IG", "twitter": "TW",
           "foursquare": "4S", "weibo": "WB"}


def month_of(ts):
    return ts.strftime("%Y%b")


def active(merchants, as_of):
    return {m[0] for m in merchants if m[2][0] is not None and not (as_of > m[2][0])}


def own_ids(merchants):
    out = set()
    for mid, _name, _sub, accounts in merchants:
        for service, accs in (accounts or {}).items():
            if service in SERVICE:
                for a in accs or []:
                    out.add((mid, SERVICE[service] + "-" + a[0]))
    return out


def matches(posts, places, merchants, as_of, month):
    """(place, post) for every shared venue: one entry per matching venue pair."""
    act = active(merchants, as_of)
    for pl in places:
        if pl[2] not in act:
            continue
        for v in pl[3] or []:
            for p in posts:
                if month_of(p[1]) == month and v in (p[2] or []):
                    yield pl, p


def _own(own, pl, p):
    return (pl[2], p[5]) in own


def content(posts, places, merchants, as_of, month):
    own = own_ids(merchants)
    rows = {(pl[2], pl[1], p[0], month, p[0][:2], p[3]) for pl, p in matches(posts, places, merchants, as_of, month)
            if not _own(own, pl, p)}
    c = Counter((m, n, mo, s, k) for m, n, _pid, mo, s, k in rows)
    tot = Counter()
    for (m, n, mo, _s, _k), v in c.items():
        tot[(m, n, mo)] += v
    return sorted((m, n, mo, s, k, v, tot[(m, n, mo)]) for (m, n, mo, s, k), v in c.items())


def reviews(posts, places, merchants, as_of, month):
    own = own_ids(merchants)
    rows = {(pl[2], pl[1], month, p[0][:2], p[0], p[6][0] if p[6] else None)
            for pl, p in matches(posts, places, merchants, as_of, month)
            if not _own(own, pl, p) and p[3] == "review" and p[0][:2] == "FB"}
    c = Counter((m, n, mo, s, v) for m, n, mo, s, _pid, v in rows)
    return sorted(((m, n, mo, s, v, k) for (m, n, mo, s, v), k in c.items()), key=repr)


def keywords(posts, places, merchants, as_of, month):
    own = own_ids(merchants)
    rows = {(pl[2], pl[1], month, p[4], p[0][:2]) for pl, p in matches(posts, places, merchants, as_of, month)
            if not _own(own, pl, p) and p[4] is not None and p[4] != ""}
    c = Counter()
    for m, n, mo, text, s in rows:
        for w in py_tokens(py_text_strip(text)):
            c[(m, n, mo, w, s)] += 1
    tot = Counter()
    for (m, n, mo, w, _s), v in c.items():
        tot[(m, n, mo, w)] += v
    return sorted((m, n, mo, w, s, v, tot[(m, n, mo, w)]) for (m, n, mo, w, s), v in c.items()
                  if tot[(m, n, mo, w)] > 1)


def posters(posts, places, merchants, as_of, month):
    own = own_ids(merchants)
    rows = {(pl[2], pl[1], month, p[0][:2], p[5]) for pl, p in matches(posts, places, merchants, as_of, month)
            if not _own(own, pl, p)}
    c = Counter((m, n, mo, s) for m, n, mo, s, _poster in rows)
    tot = Counter()
    for (m, n, mo, _s), v in c.items():
        tot[(m, n, mo)] += v
    return sorted((m, n, mo, s, v, tot[(m, n, mo)]) for (m, n, mo, s), v in c.items())


def segments(posts, places, merchants, as_of, month):
    rows = {(pl[2], pl[0], p[0], month, p[1].strftime("%d"), p[1].strftime("%H"), p[0][:2])
            for pl, p in matches(posts, places, merchants, as_of, month)}
    c = Counter()
    for m, pid, _post, mo, d, h, s in rows:
        c[(m, pid, mo, d, h, s)] += 1
        c[(m, pid, mo, d, "total", s)] += 1
    return sorted((m, pid, mo, d, "PC", h, s, v) for (m, pid, mo, d, h, s), v in c.items())


def interactions(posts, places, merchants, audits, as_of, month):
    own = own_ids(merchants)
    pp = {(pl[1], p[0], pl[2]) for pl, p in matches(posts, places, merchants, as_of, month) if not _own(own, pl, p)}
    a = set()
    for _id, _cat, typ, mid, created, actor, subject in audits:
        if typ in ("like", "reply", "tag", "follow") and month_of(created) == month:
            pid = subject[1]
            a.add((typ, mid, month, actor[2], pid, pid[:2] if pid is not None else None))
    follows = [x for x in a if x[0] == "follow"]
    inter = [x for x in a if x[0] in ("like", "reply", "tag")]
    uniq = {("int",) + x[1:] for x in inter if x[0] in ("like", "reply")}
    matched = [(typ, user, src, mo, name, m)
               for typ, mid, mo, user, pid, src in inter + sorted(uniq, key=repr)
               for name, ppid, m in pp if ppid == pid and m == mid]
    pu = {(user, name, m) for _t, user, _s, _mo, name, m in matched}
    placed = [(typ, user, src, mo, name, m) for typ, mid, mo, user, _pid, src in follows
              for u, name, m in pu if u == user and m == mid]
    c = Counter((m, name, mo, user, src, typ) for typ, user, src, mo, name, m in matched + placed)
    return sorted(((m, n, mo, u, s, t, v) for (m, n, mo, u, s, t), v in c.items()), key=repr)


def response_times(posts, audits, month, wrap=False):
    a = set()
    for _id, _cat, typ, mid, created, actor, subject in audits:
        if typ in ("like", "reply", "tag", "follow") and month_of(created) == month:
            a.add((typ, created, month, actor[2], subject[1], mid))
    by_id = defaultdict(list)
    for p in posts:
        by_id[p[0]].append(p)
    mins = {}
    for _typ, created, mo, user, pid, mid in a:
        for p in by_id.get(pid, []):
            d = calendar.timegm(created.timetuple()) - calendar.timegm(p[1].timetuple())  # whole seconds, UTC
            if wrap:
                d %= 86400
            k = (mid, user, mo, pid)
            mins[k] = d if k not in mins else min(mins[k], d)
    per = defaultdict(list)
    for (mid, user, mo, _pid), v in mins.items():
        per[(mid, mo, user)].append(v)
    return sorted(((m, mo, u, sum(v) / len(v)) for (m, mo, u), v in per.items()), key=repr)
