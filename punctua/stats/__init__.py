from punctua.stats.bootstrap import *  # noqa: F401,F403
from punctua.stats.intervals import *  # noqa: F401,F403
from punctua.stats.left_out import *  # noqa: F401,F403
from punctua.stats.logit import *  # noqa: F401,F403
from punctua.stats.study import *  # noqa: F401,F403
