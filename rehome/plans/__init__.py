"""Composite plans (PL1-PL10) and the bindings of operators to driver tables."""

# Import prerequisite order carried as ``stage`` on plan rows:
# profiles -> users -> groups -> group roles -> user roles -> pools ->
# clusters -> jobs -> workspace items -> ACLs -> databases -> table definitions.
STAGE = {
    "profiles": 1, "users": 2, "groups": 3, "group_roles": 4, "user_roles": 5,
    "pools": 6, "clusters": 7, "jobs": 8, "workspace": 9, "acls": 10, "databases": 11, "tables": 12,
}

# Emptying a target workspace is a procedure of its own.
CLEANUP_STAGE = {"unpin": 101, "clusters": 102, "jobs": 103}
