"""Plain restatements of the operators as loops, to hold them against."""

from __future__ import annotations


def islands(words, label, tolerance):
    out, span = [], None
    for speaker, start, end, flag in words:
        if speaker is None:
            continue
        if speaker == label:
            if span:
                out.append(tuple(span))
            span = None
        elif span and start - span[1] <= tolerance and flag == span[2]:
            span[1] = end
        else:
            if span:
                out.append(tuple(span))
            span = [start, end, flag]
    return out + ([tuple(span)] if span else [])


def lead(spans, tolerance):
    end = 0.0
    for a, b in sorted(spans):
        if a > end + tolerance:
            break
        end = max(end, b)
    return end


def clips(spans):
    out, edge = [], 0
    for a, b, i in sorted(spans):
        a = max(a, edge)
        if b > a:
            out.append((a, b, i))
            edge = b
    return out


def united(spans):
    out = []
    for a, b, i in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b, i])
    return [tuple(x) for x in out]


def iou(a, b):
    w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
    if w <= 0 or h <= 0:
        return 0.0
    return w * h / ((a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - w * h)


def band(points, zone):
    out, now = [], points[0] if points else 0
    for x in points:
        if x > now + zone:
            now = x - zone
        elif x < now - zone:
            now = x + zone
        out.append(now)
    return out
