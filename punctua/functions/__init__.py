from punctua.functions.scalars import *  # noqa: F401,F403
from punctua.functions.timezones import *  # noqa: F401,F403
