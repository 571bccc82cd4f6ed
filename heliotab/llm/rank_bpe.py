"""Token ids of texts under a rank file, by tiktoken, for texts of any shape."""

import re
from functools import lru_cache

from heliotab.llm.secret_scan import _encoding

#: White space runs from this length on are cut out before the library's pattern sees the text: it looks ahead behind such a run and steps back one by one, on a stack that a run of some 100,000 overflows.
LONG_RUN = 1024
#: The code points of Unicode white space, which the pattern's \s means.
WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
_LONG = re.compile("[%s]{%d,}" % ("".join(map(chr, WHITE)), LONG_RUN))


class RankBPE:
    """A rank file with the pre-token pattern of the public tokenizers."""

    def __init__(self, path: str):
        import tiktoken

        self.library = _encoding(path)
        ranks = {token: self.library.encode_single_token(token) for token in self.library.token_byte_values()}
        self.single = tiktoken.Encoding("single", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={})
        self.largest = self.library.max_token_value

    def piece(self, pre_token: str) -> list[int]:
        """The ids of one match of the pattern."""
        return self.single.encode_ordinary(pre_token)

    def encode(self, text: str) -> list[int]:
        """The ids of a text. A long run of white space is one pre-token up to the end of the text, or up to its last character, which belongs to what follows."""
        ids, at = [], 0
        for m in _LONG.finditer(text):
            stop = m.end() if m.end() == len(text) else m.end() - 1
            ids += self.library.encode_ordinary(text[at : m.start()])
            ids += self.piece(text[m.start() : stop])
            at = stop
        return ids + self.library.encode_ordinary(text[at:]) if at else self.library.encode_ordinary(text)


@lru_cache(2)
def loaded(path: str) -> RankBPE:
    """One for each file and worker process."""
    return RankBPE(path)
