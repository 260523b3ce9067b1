"""What reads Python source; expected values follow from the rules, worked out by hand."""

import pytest

from corpusloom.functions import pycode

MODULE = '''import torch.nn as nn
# a note
def helper(x):
    return x

def unused(x):
    return helper(x)

class Net(nn.Module):
    """Doc."""
    def __init__(self):
        super().__init__()
        self.a = nn.Conv2d(3, 16, kernel_size=5)
        self.b = nn.Linear(in_features=10, out_features=4)
    def forward(self, x):
        def forward(y):
            return y
        return helper(self.a(x))
'''


def test_region_is_modules_and_called_helpers():
    region = pycode.model_region(MODULE)
    assert "class Net" in region and "def helper" in region and "unused" not in region and "import" not in region
    assert pycode.model_region("x = 1\n") == "x = 1\n" and pycode.model_region("def (") == "def ("


def test_comments_and_first_strings_go():
    assert '"""' not in pycode.without_comments('def f():\n    """doc"""\n    return 1\n')
    assert "kept" in pycode.without_comments("# c\n'kept'\n")  # what stands before isn't a logical line's end
    assert "#" not in pycode.without_comments("def (  # broken\n")


def test_token_stream():
    assert pycode.code_tokens("x = Conv2d(3, 'a') + fooBar\n") == ["ID", "=", "Conv2d", "(", "NUM", ",", "STR", ")", "+", "fooBar"]
    assert pycode.code_tokens("mine = 1\n", {"mine"}) == ["mine", "=", "NUM"]
    assert pycode.code_tokens("if x:\n  a\n b\n") == []


@pytest.mark.parametrize("value, want", [("3", "4"), ("0", "0"), ("True", "1"), ("-1", None), ("(3, n)", "(4,X)"), ("0.3", "0"), ("6", "8"), ("1" + "0" * 400, None), ("(3, 1" + "0" * 400 + ")", "(4,X)"), ("x", None), ("float('x')", None)])
def test_hyperparameter_buckets(value, want):
    found = pycode.fingerprint(f"f(kernel_size={value})")[2]
    assert found == ([("kernel_size", want)] if want is not None else [])


@pytest.mark.parametrize(
    "source, want",
    [
        ("def f():\n    '''doc'''\n    return 1  # note\n", "def f ( ) : return NUM"),
        ("# note\n'kept'\nx = 'a'\n", "STR ID = STR"),  # a comment's line end is no logical line's end
        ("'gone' 'kept'\n", "STR"),
        ("'gone'.join(x)\n", ". ID ( ID )"),
        ("x = a\\\nif b else c\n", "ID = ID ID else ID"),  # the break goes, and 'a' and 'if' become one name
        ("if x:\n\ta\n\tb\n", ""),  # a tab is one column here, so the second line is indented less
        ("x = f'{a} {{b}}'\n", "ID = ID"),
        ("def (\n", ""),
        ("x = (1,\n  # note\n  2)\n", "ID = ( NUM , NUM )"),
    ],
)
def test_token_streams_without_comments(source, want):
    if "{{" in source:  # how such a string is put together again depends on Python's tokenizer; both ways must agree
        assert pycode.stream(source, set(), True) == pycode.code_tokens(pycode.without_comments(source))
    else:
        assert " ".join(pycode.normal_tokens(source)) == want


@pytest.mark.parametrize("source", [MODULE, "class A:\n    class B(nn.Module):\n        def f(self):\n            'doc'\n            return f'{self.x!r}'\n", "x = 1;  'y'\n", "'''a\nb'''\nz = '''c\n d'''\n"])
def test_one_reading_gives_the_same(source):
    region, declared = pycode._region(source, pycode._tree(source))
    assert declared == pycode.declared_names(region)
    assert pycode.stream(region, declared, True) == pycode.code_tokens(pycode.without_comments(region), declared)


def test_fingerprints():
    a, b = pycode.fingerprint("f(g())\nh()"), pycode.fingerprint("h()\nf(g())")
    assert a[0] == ["f", "g", "h"] and b[0] == ["h", "f", "g"] and a[1] == b[1]
    assert pycode.fingerprint_hash(a) != pycode.fingerprint_hash(b)
    assert pycode.fingerprint("def (") == ([], [], []) and len(pycode.fingerprint("f()\n" * 300)[0]) == 256


def test_summary():
    s = pycode.summary(MODULE)
    assert s["has_module"] and s["param_estimate"] == 3 * 16 * 25 + 40 and s["class_names"] == ["Net"]
    assert pycode.summary("def (") is None
    assert pycode.summary("padding = 1")["family"] == "resnet"  # a cue is any part of the text
    assert pycode.summary("x = MaxPool2d(2)")["family"] == "vgg"


def test_masked_forward():
    masked = pycode.masked_forward(MODULE)
    assert "raise NotImplementedError()" in masked and "helper(self.a(x))" not in masked and "# a note" not in masked
    assert pycode.masked_forward("def f():\n    def forward(): return 1\n").count("NotImplementedError") == 0
    assert pycode.masked_forward("def (") is None


@pytest.mark.parametrize(
    "answer, code",
    [
        ("x = 1", "x = 1"),
        ("a ```python\nx = 1\n``` b ```python\nxx = (\n``` c", "x = 1"),
        ("```\ny = 2\n```", "y = 2"),
        ("```python\nx = (\n``` ```python\ny = [[\n```", "y = [["),
    ],
)
def test_one_block(answer, code):
    block = pycode.one_block(answer)
    assert pycode.fenced_code(block) == code


def test_first_block():
    assert pycode.first_block("a ```python\nx = (\n``` ```python\ny = 1\n```") == "```python\nx = (\n```"
    assert pycode.first_block("x") == "```python\nx\n```"
    assert pycode.first_block("```\nx\n``` ```python\ny\n```") == "```python\ny\n```"
    assert pycode.parseable_block("```python\ny\n```") and not pycode.parseable_block("```python\ny (\n```") and not pycode.parseable_block("y")
