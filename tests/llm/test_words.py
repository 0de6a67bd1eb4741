"""Ids of words without the tokenizer's splitting."""

import numpy as np

from ledgerloom.llm import packing


def test_words_of_letters_and_signs_need_no_splitting():
    words = packing.WordIds(packing.vocabulary())
    texts = ["he,&&& $$$ River*** mill... ÉTÉ?! \"quoted\" it's", "", " river  he,&&&\n"]
    want = [[*words.tokenizer.encode(t, add_special_tokens=False).ids, packing.END] for t in texts]
    ids, per_word, n, _ = packing.text_ids(words, [t.encode() for t in texts])
    assert [x.tolist() for x in np.split(ids, np.cumsum(np.add.reduceat(per_word, np.cumsum(n) - n))[:-1])] == want
    words = packing.WordIds(packing.vocabulary())
    words.tokenizer = None  # only other words go to it
    assert packing.text_ids(words, ["he,&&& $$$ River*** mill... ÉTÉ?!".encode()])[0].tolist() == want[0][: len(words.ids(np.arange(1, 6))[0])] + [packing.END]


def test_words_kept_from_earlier_texts_and_letters_of_all_kinds():
    """Every letter under U+0250 and others, marks, signs within, capitals, each met twice: ids are those of the tokenizer on the text."""
    letters = [chr(c) for c in (*range(0x41, 0x250), 0x3A3, 0x416, 0x10D0, 0x1E9E, 0x4E2D, 0xAC00) if chr(c).isalpha()]
    texts = [" ".join(f"{c} {c}x, Ab{c}?! {c}{c}*** {c}1" for c in letters[k : k + 40]) for k in range(0, len(letters), 40)]
    texts += ["", "  ", "İstanbul été, a-b 'it's' #tag 12,5 … naïve-é 日本語!", "...,, ÉtÉ\tété "]
    words = packing.WordIds(packing.vocabulary())
    for own in (texts, texts[::-1], [""], []):
        want = [[*words.tokenizer.encode(t, add_special_tokens=False).ids, packing.END] for t in own]
        ids, per_word, n, numbers = packing.text_ids(words, [t.encode() for t in own])
        assert ids.tolist() == sum(want, []) and len(numbers) == len(per_word) == n.sum()
        assert [per_word[a : a + k].sum() for a, k in zip(np.cumsum(n) - n, n)] == list(map(len, want))


def test_a_part_is_learned_once_whatever_its_words():
    words, seen = packing.WordIds(packing.vocabulary()), []
    learn = words._learn
    words._learn = lambda parts: seen.extend(parts) or learn(parts)
    for texts in ([b"River river, RIVER! mill"], [b"river? \xc3\x89t\xc3\xa9 mill,"], [b"\xc3\x89t\xc3\xa9, river!"]):
        packing.text_ids(words, texts)
    assert sorted(seen) == sorted({b"river", b",", b"!", b"mill", b"?", b"\xc3\x89t\xc3\xa9"})
