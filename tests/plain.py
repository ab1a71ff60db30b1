"""The two rules as plain loops, to compare with."""


def rise(values):
    n = len(values)
    if n <= 1:
        return False
    size = 1 + n // 10
    first = last = 0.0
    for v in values[:size]:
        first += v
    for v in values[n - size:]:
        last += v
    return last / size - first / size > 10


def fold(values):
    first, second, third, high, count = -1.0, 0.0, -1000.0, False, 0
    for p in values:
        if first <= p:
            if first == -1:
                first = 0.0
            else:
                first = (p - second) + first
                if first >= 1:
                    high, count = True, count + 1
            second = p
        elif third >= p:
            if third == -1000:
                third = 0.0
            else:
                third = (p - second) + third
                if third >= 1:
                    high = False
            second = p
    return high, count, first, second, third
