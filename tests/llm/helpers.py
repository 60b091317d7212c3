from pathlib import Path

import public_tokenizers


def vocabulary(name):
    return Path(public_tokenizers.path(name)).read_text(encoding="utf-8")
