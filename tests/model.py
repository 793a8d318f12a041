"""A plain model of the chunker, written from its rules, to compare with."""

from __future__ import annotations


def groups_of(rows):
    """``[headings, texts, first page, last page]`` of ``(h1, h2, h3, text, page)`` rows."""
    groups, carried = [], (None, None, None)
    for h1, h2, h3, text, page in rows:
        own = (h1, h2, h3)
        if any(h and h != c for h, c in zip(own, carried)):
            carried = (h1 or carried[0], h2 if h1 or h2 else carried[1], h3)
            deepest = h3 or h2 or h1
            text = text if text.lstrip().startswith(deepest) else f"{deepest}\n{text}"
            groups.append([carried, [text], page, page])
            continue
        if not groups:
            groups.append([carried, [], None, None])
        group = groups[-1]
        group[1].append(text)
        if page is not None:
            group[2] = page if group[2] is None else group[2]
            group[3] = page
    return groups


def packed(texts, max_length, overlap):
    """Chunks as slices ``[start, end)`` of all texts joined."""
    whole, start, end, out = "", 0, 0, []
    for text in texts:
        if end - start + len(text) + 1 > max_length:
            out.append(whole[start:end].strip())
            start = max(start, end - overlap)
        whole += text + "\n"
        end = len(whole)
    rest = whole[start:end].strip()
    return out + [rest] if rest else out


def chunks_of(rows, max_length, overlap):
    return [
        (content, *headings, first, last)
        for headings, texts, first, last in groups_of(rows)
        for content in packed(texts, max_length, overlap)
    ]
