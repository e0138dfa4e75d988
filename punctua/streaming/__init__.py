from punctua.streaming.alerts import *  # noqa: F401,F403
from punctua.streaming.loads import *  # noqa: F401,F403
from punctua.streaming.refresh import *  # noqa: F401,F403
