"""Names that functions look up exist: what isn't imported shows before a query runs into it."""

import builtins
import dis
import importlib
import pkgutil
import types

import quireon


def looked_up(code: types.CodeType) -> set[str]:
    inner = [looked_up(c) for c in code.co_consts if isinstance(c, types.CodeType)]
    return {i.argval for i in dis.get_instructions(code) if i.opname == "LOAD_GLOBAL"}.union(*inner)


def test_modules_know_the_names_they_use():
    missing = set()
    for m in pkgutil.walk_packages(quireon.__path__, "quireon."):
        module = importlib.import_module(m.name)
        with open(module.__file__) as f:
            names = looked_up(compile(f.read(), module.__file__, "exec"))
        missing |= {(m.name, n) for n in names if not hasattr(module, n) and not hasattr(builtins, n)}
    assert not missing
