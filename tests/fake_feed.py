def fetch(location):
    if location == "Nowhere":
        raise OSError("no such place")
    return '{"name": "%s"}' % location


def located(location, tick, root):
    return f"{location}/{tick}/{root}"
