from punctua.operators.aggregates import *  # noqa: F401,F403
from punctua.operators.asof import *  # noqa: F401,F403
from punctua.operators.dedup import *  # noqa: F401,F403
from punctua.operators.relational import *  # noqa: F401,F403
from punctua.operators.quantiles import *  # noqa: F401,F403
