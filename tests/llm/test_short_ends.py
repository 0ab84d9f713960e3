from tallyweir.llm.linkage import ends


def test_short_ends_that_miss_a_letter_meet():
    for name in ("qatar", "marsa", "doha", "abcdefgh"):
        for i in range(len(name)):
            assert ends([name]) & ends([name[:i] + name[i + 1 :]])
