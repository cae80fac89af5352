"""A list store of one process behind a socket, as far as the queue source and sink need one."""

import socketserver
import threading


class Store:
    def __init__(self):
        self.lists, self.values, self.lock, self.refuse = {}, {}, threading.RLock(), set()

    def do(self, words):
        name, *args = [w.decode() if i == 0 else w for i, w in enumerate(words)]
        if name.upper() in self.refuse:
            raise ValueError(f"{name} is refused")
        return getattr(self, name.lower())(*args)

    def ping(self):
        return "PONG"

    def get(self, key):
        return self.values.get(key)

    def set(self, key, value):
        self.values[key] = value
        return "OK"

    def delete(self, *keys):
        return sum(1 for k in keys if self.lists.pop(k, self.values.pop(k, None)) is not None)

    def expire(self, key, seconds):
        return int(key in self.lists)

    def lpush(self, key, *values):
        held = self.lists.setdefault(key, [])
        held[:0] = values[::-1]
        return len(held)

    def rpop(self, key):
        held = self.lists.get(key)
        out = held.pop() if held else None
        if held == []:
            del self.lists[key]
        return out

    def rpoplpush(self, key, other):
        value = self.rpop(key)
        if value is not None:
            self.lpush(other, value)
        return value

    def llen(self, key):
        return len(self.lists.get(key, ()))

    def _cut(self, key, start, stop):
        held = self.lists.get(key, [])
        start, stop = (int(x) + len(held) if int(x) < 0 else int(x) for x in (start, stop))
        return held[max(start, 0) : max(stop + 1, 0)]

    def lrange(self, key, start, stop):
        return self._cut(key, start, stop)

    def ltrim(self, key, start, stop):
        kept = self._cut(key, start, stop)
        if kept:
            self.lists[key] = kept
        else:
            self.lists.pop(key, None)
        return "OK"


def encoded(reply):
    if reply is None:
        return b"$-1\r\n"
    if isinstance(reply, Exception):
        return f"-ERR {reply}\r\n".encode()
    if isinstance(reply, bool | int):
        return b":%d\r\n" % reply
    if isinstance(reply, str):
        return f"+{reply}\r\n".encode()
    if isinstance(reply, list):
        return b"*%d\r\n" % len(reply) + b"".join(map(encoded, reply))
    return b"$%d\r\n%s\r\n" % (len(reply), reply)


class Handler(socketserver.StreamRequestHandler):
    def handle(self):
        store, queued = self.server.store, None
        while line := self.rfile.readline():
            words = []
            for _ in range(int(line[1:])):
                size = int(self.rfile.readline()[1:])
                words.append(self.rfile.read(size + 2)[:-2])
            name = words[0].upper()
            words[0] = b"delete" if name == b"DEL" else words[0]
            if name == b"MULTI":
                queued, reply = [], "OK"
            elif name == b"EXEC":
                with store.lock:
                    try:
                        reply = [store.do(w) for w in queued]
                    except Exception as e:
                        reply = e
                queued = None
            elif queued is not None:
                queued.append(words)
                reply = "QUEUED"
            else:
                with store.lock:
                    try:
                        reply = store.do(words)
                    except Exception as e:
                        reply = e
            self.wfile.write(encoded(reply))


class Server(socketserver.ThreadingTCPServer):
    allow_reuse_address, daemon_threads = True, True

    def __init__(self):
        super().__init__(("localhost", 0), Handler)
        self.store = Store()
        threading.Thread(target=self.serve_forever, daemon=True).start()

    @property
    def port(self):
        return self.server_address[1]

    def push(self, key, *lines):
        with self.store.lock:
            for line in lines:
                self.store.lpush(key.encode(), line.encode())

    def lines(self, key):
        """The lines of a list, oldest first."""
        with self.store.lock:
            return [x.decode() for x in reversed(self.store.lists.get(key.encode(), []))]
