"""Files of fixture trees."""

import os


def write(path, text, mode="w"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, mode, newline="") as f:
        f.write(text)
    return path
