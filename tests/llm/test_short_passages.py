"""Line dedup of passages and texts with fewer lines than a run."""

from weblattice.llm import winnowed_lines


def words(name, n):
    return " ".join(f"{name}{i}" for i in range(n))


def test_passages_of_one_or_two_lines_and_copied_short_texts(frame):
    passage, half, other = words("p", 50), words("h", 30), words("o", 30)
    texts = [
        f"a\n{passage}\nb", f"c\nd\n  {passage.replace(' ', '  ', 3)}\ne", f"f\n{half}\n{other}\ng", f"k\n{half}\n\n{other}\nl", f"m\n{half}\nn",
        "One short line.", "One short line.", "two\nlines", "two \n\nlines", "x\nOne short line.\ny", passage, None, "", " \n",
        f"q\n{words('s', 49)}\nr", f"t\n{words('s', 49)}\nu"]
    got = {r["doc_id"]: (r["text"], r["n_removed"]) for r in winnowed_lines.deduplicated(frame(list(enumerate(texts)))).collect()}
    changed = {1: ("c\nd\ne", 1), 3: ("k\n\nl", 2), 6: ("", 1), 8: ("", 2), 10: ("", 1)}
    for i, text in enumerate(texts):
        if i not in changed:
            assert got[i] == (text, 0), i
    assert got[1] == changed[1] and got[3] == changed[3] and got[6] == changed[6] and got[8][1] == 2 and got[10] == changed[10]
