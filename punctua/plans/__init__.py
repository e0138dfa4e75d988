from punctua.plans.analysis import *  # noqa: F401,F403
from punctua.plans.fact import *  # noqa: F401,F403
from punctua.plans.health import *  # noqa: F401,F403
from punctua.plans.quality import *  # noqa: F401,F403
from punctua.plans.reports import *  # noqa: F401,F403
from punctua.plans.staging import *  # noqa: F401,F403
from punctua.plans.throttle import *  # noqa: F401,F403
